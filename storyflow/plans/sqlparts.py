"""Expressions shared by the oracle SQL texts."""


def seconds(x: str) -> str:
    """Lenient seconds of a time text."""
    p = f"string_split(trim({x},'[] '),':')"
    s = f"string_split(({p})[3],'.')"
    whole = r"'\s*[+-]?[0-9]+\s*'"
    part = lambda c: f"CAST(CASE WHEN regexp_full_match({c},{whole}) THEN try_cast(trim({c}) AS BIGINT) END AS DOUBLE)"
    frac = f"CASE WHEN len({s})>1 THEN try_cast('0.'||({s})[2] AS DOUBLE) ELSE 0.0 END"
    return f"COALESCE(CASE WHEN len({p})=3 THEN {part(f'({p})[1]')}*3600+{part(f'({p})[2]')}*60+{part(f'({s})[1]')}+{frac} END,0.0)"


def clock(x: str) -> str:
    """[HH:MM:SS] of the nearest whole second, halves to even."""
    s = f"CAST(round_even({x},0) AS BIGINT)"
    return f"printf('[%02d:%02d:%02d]',{s}//3600,({s}%3600)//60,{s}%60)"


#: The events of the progress table, each once.
EVENTS = (
    "ev AS (SELECT DISTINCT video_id,run_id,chunk_i,ev_i,chunk_time_range,start_time,end_time,step1_objective_visual,"
    "step2_contextual_reasoning,step3_synthesized_dense_caption,key_frame_times FROM pass1_progress)"
)
#: The pairs of the refined table, each once.
PAIRS = (
    "pr AS (SELECT DISTINCT video_id,run_id,event_id,ch_idx,start_time,end_time,step3_synthesized_dense_caption,frame_caption,frame_timestamps,source FROM stage2_refined)"
)
#: The chapters of the final table, each once.
CHAPTERS = "ch AS (SELECT DISTINCT video_id,run_id,ch_idx,chapter_id,title,chapter_summary,start_time,end_time FROM pass3_final)"
#: Sightings: the characters named in the events of the chapter table.
SIGHTINGS = (
    "f AS (SELECT DISTINCT run_id,ch_idx,events FROM pass3_final),"
    "fe AS (SELECT run_id,ch_idx,events,unnest(range(len(events))) AS ev_pos FROM f),"
    "fc AS (SELECT run_id,ch_idx,ev_pos,events[ev_pos+1] AS e FROM fe),"
    "fp AS (SELECT run_id,ch_idx,ev_pos,e,unnest(range(len(e.characters_in_event))) AS c_pos FROM fc),"
    "sg AS (SELECT run_id,ch_idx,ev_pos,c_pos,e.characters_in_event[c_pos+1].name AS temp_name,e.characters_in_event[c_pos+1].\"desc\" AS descr,e.start_time AS anchor_ts"
    " FROM fp WHERE e.characters_in_event[c_pos+1] IS NOT NULL)"
)
NORM_CHARS = "[]【】《》〈〉<>「」『』 \t\r\n"


def norm(x: str) -> str:
    """A name without brackets, blanks and case."""
    chars = "'[]【】《》〈〉<>「」『』 '||chr(9)||chr(13)||chr(10)"
    return f"COALESCE(lower(trim(trim({x},{chars}))),'')"
