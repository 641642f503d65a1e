"""Registered queries about chapters, story texts, refinement and usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import cut, load
from ..functions import text as X
from ..operators import chapters as C
from ..operators import refine as R
from ..operators import story as Y
from ..operators import usage as U
from ..sources import adapters as A
from ..sources import videos as V
from . import sqlparts as P

D = DataFrame


def _mount_inputs(spark: SparkSession, d: str) -> tuple[D, D]:
    ch = A.chapters(spark, d, "start_time", "end_time")
    ev = A.events(spark, d, "start_time").join(ch.select("run_id").distinct(), "run_id", "left_semi")
    return ev, ch


def chapter_mount(spark: SparkSession, d: str) -> D:
    return C.mount(*_mount_inputs(spark, d))


def chapter_mount_once(spark: SparkSession, d: str) -> D:
    return C.mount(*_mount_inputs(spark, d), once=True)


def chapter_overflow(spark: SparkSession, d: str) -> D:
    """Over chapters that start late and end at once, so that events are lost
    before them and stand behind the last one's own end."""
    ev, ch = _mount_inputs(spark, d)
    ch = ch.where("ch_idx > 0").withColumn("end_time", F.col("start_time"))
    return C.overflow(ev, ch, cut(C.mount(ev, ch)))


def chapter_lost(spark: SparkSession, d: str) -> D:
    ev, ch = _mount_inputs(spark, d)
    return C.overflow(ev, ch, cut(C.mount(ev, ch)), lost_only=True)


def chapter_fallback_single(spark: SparkSession, d: str) -> D:
    return C.single_chapter(A.events(spark, d, "start_time", "end_time"), A.chapters(spark, d))


def last_wins_bank(spark: SparkSession, d: str) -> D:
    return C.last_described(A.sightings(spark, d), "run_id", ["ch_idx", "ev_pos", "c_pos"])


def event_characters(spark: SparkSession, d: str) -> D:
    t = A.pairs(spark, d, "step3_synthesized_dense_caption")
    return C.event_characters(t, last_wins_bank(spark, d), "run_id", "event_id", "step3_synthesized_dense_caption")


def timeline_text(spark: SparkSession, d: str) -> D:
    e = A.events(spark, d, "start_time", "end_time", "step3_synthesized_dense_caption")
    n = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.concat(n("start_time"), F.lit(" - "), n("end_time"), F.lit(" : "), n("step3_synthesized_dense_caption"))
    return Y.joined(e, ["run_id", "chunk_i"], ["ev_i"], line)


def chunk_summaries(spark: SparkSession, d: str) -> D:
    c = A.chapters(spark, d, "chapter_summary", "start_time", "end_time")
    span = F.concat(F.coalesce("start_time", F.lit("?")), F.lit(" - "), F.coalesce("end_time", F.lit("?")))
    s = Y.flat(F.col("chapter_summary"))
    line = F.concat(F.lit("Part "), (F.col("ch_idx") + 1).cast("string"), F.lit(" "), span, F.lit(": "), F.when(s == "", F.lit("(no summary)")).otherwise(s))
    return Y.joined(c, ["run_id"], ["ch_idx"], line)


def bank_text(spark: SparkSession, d: str) -> D:
    s = Y.flat(F.col("descr"))
    line = F.concat(F.lit("- "), F.col("name"), F.when(s == "", F.lit("")).otherwise(F.concat(F.lit(": "), s)))
    return Y.joined(last_wins_bank(spark, d), ["run_id"], ["name"], line)


def story_so_far(spark: SparkSession, d: str) -> D:
    return Y.story_so_far(A.chapters(spark, d, "chapter_summary"), "run_id", "ch_idx", F.col("chapter_summary"))


def stage2_start_adjust(spark: SparkSession, d: str) -> D:
    p = A.pairs(spark, d, "ch_idx", "start_time", "end_time")
    return R.adjusted_start(p, "run_id", ["ch_idx", "event_id"]).select("run_id", "event_id", "start_sec", "end_sec", "actual_start")


def previous_caption(spark: SparkSession, d: str) -> D:
    p = A.pairs(spark, d, "ch_idx", "frame_caption")
    return R.previous_caption(p, ["run_id", "ch_idx"], "event_id", "frame_caption").select("run_id", "event_id", "previous")


def refine_progress(spark: SparkSession, d: str) -> D:
    return R.progress(A.pairs(spark, d, "frame_caption"), ["run_id"], "frame_caption")


def polish_payload(spark: SparkSession, d: str) -> D:
    p = A.pairs(spark, d, "ch_idx", "frame_caption", "step3_synthesized_dense_caption")
    c = p.withColumn("cap", R.first_filled(F.col("frame_caption"), F.col("step3_synthesized_dense_caption"))).where("cap <> ''")
    return Y.joined(c, ["run_id", "ch_idx"], ["event_id"], F.concat("event_id", F.lit("="), "cap"), name="payload")


def final_caption(spark: SparkSession, d: str) -> D:
    one = load(spark, d, "stage3_polished", A.POLISHED_CAPTIONS).dropDuplicates(["run_id"])
    flat = one.select("run_id", F.posexplode("chapters.events").alias("ci", "es")).select("run_id", "ci", F.posexplode("es").alias("ei", "e"))
    p = R.polished_captions(flat.select("run_id", "ci", "ei", F.col("e.event_id").alias("event_id"), F.col("e.final_caption").alias("caption")).where("coalesce(event_id, '') <> ''"), ["run_id", "event_id"], ["ci", "ei"])
    e = A.pairs(spark, d, "frame_caption", "step3_synthesized_dense_caption").join(p, ["run_id", "event_id"], "left")
    return e.select("run_id", "event_id", R.first_filled(F.col("polished"), F.col("frame_caption"), F.col("step3_synthesized_dense_caption")).alias("final_caption"))


def storyboard_flat(spark: SparkSession, d: str) -> D:
    one = load(spark, d, "stage3_polished", A.POLISHED_FLAT).dropDuplicates(["run_id"])
    c = one.select("run_id", F.posexplode("chapters").alias("ci", "c")).where("c is not null")
    e = c.select("run_id", "ci", F.coalesce("c.chapter_id", F.lit("")).alias("chapter_id"), F.coalesce("c.title", F.lit("")).alias("title"), F.posexplode("c.events").alias("ei", "e")).where("e is not null")
    return e.select("run_id", "ci", "chapter_id", "title", "ei", "e.event_id", "e.start_time", "e.end_time", F.coalesce(F.size("e.characters_in_event"), F.lit(0)).cast("bigint").alias("n_characters"))


def _calls(spark: SparkSession, d: str) -> D:
    """Recorded model calls stand in as a rule over text lengths."""
    p = A.pairs(spark, d, "video_id", "source", "step3_synthesized_dense_caption", "frame_caption")
    a, b = F.length("step3_synthesized_dense_caption"), F.length("frame_caption")
    return p.select("video_id", "run_id", F.col("source").alias("stage"), F.when(b.isNotNull(), a).alias("prompt_tokens"), b.alias("completion_tokens"), (a + b).alias("total_tokens"))


def token_by_stage(spark: SparkSession, d: str) -> D:
    return U.by(_calls(spark, d), "video_id", "stage")


def token_by_video(spark: SparkSession, d: str) -> D:
    return U.by(_calls(spark, d), "video_id")


def token_rollup(spark: SparkSession, d: str) -> D:
    return U.rollup(_calls(spark, d))


def latest_runs(spark: SparkSession, d: str) -> D:
    return U.latest(load(spark, d, "runs").distinct(), ["video_id"], ["started_at", "run_id"]).select("video_id", "run_id", "status", "error", "config_hash")


def batch_status(spark: SparkSession, d: str) -> D:
    r = load(spark, d, "runs").distinct()
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("n_runs"), F.countDistinct("video_id").alias("n_videos"), F.count_if(F.col("ended_at").isNull()).alias("n_open"), F.count("error").alias("n_errors"))


def discover_videos(spark: SparkSession, d: str) -> D:
    v = V.by_extension(load(spark, d, "videos"), "path")
    return v.select("video_id", "path", F.lower(V.extension(F.col("path"))).alias("ext"))


def sanitize_name(spark: SparkSession, d: str) -> D:
    v = load(spark, d, "videos").select(F.explode(F.array("path", F.concat(F.lit(" ."), "path", F.lit("?*. ")), F.lit(" . "))).alias("name")).distinct()
    return v.select("name", X.sanitize(F.col("name")).alias("safe"))


def run_signature(spark: SparkSession, d: str) -> D:
    r = load(spark, d, "runs").select("config_hash").distinct()
    return r.select("config_hash", X.signature(F.concat(F.lit("model/"), "config_hash"), 60, "image_list", 240, 27.0, 960, 0).alias("signature"))


def run_dir(spark: SparkSession, d: str) -> D:
    """Also over paths without an extension, with several dots and with a leading dot."""
    forms = F.array("path", F.concat("path", F.lit(".part")), F.concat(F.lit("/in/."), "ext"), F.concat(F.lit("in/"), "video_id"), F.concat(F.lit("/in/a?."), "video_id", F.lit(".")))
    v = load(spark, d, "videos").select(F.explode(forms).alias("path")).distinct()
    return v.select("path", X.run_dir(F.lit("/out/"), F.col("path"), X.signature(F.lit("m"), 60, "image_list", 240, 27.0, 960, 0)).alias("run_dir"))


def json_fence_clean(spark: SparkSession, d: str) -> D:
    raw = load(spark, d, "raw_storyboards").select("run_id", "payload").distinct()
    made = F.array(F.concat(F.lit("```json\n"), "payload", F.lit("\n```")), F.concat(F.lit(" \n```"), "payload", F.lit("``` ")), F.concat(F.lit("note: "), "payload"))
    x = raw.select("run_id", F.posexplode(made).alias("form", "txt"))
    return x.select("run_id", "form", F.md5(X.clean_json(F.col("txt"))).alias("cleaned_md5"))


def props_json(spark: SparkSession, d: str) -> D:
    e = load(spark, d, "events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return e.select("event_id", F.col("p.k").alias("k"), F.to_json(F.struct(F.col("p.k").alias("k"))).alias("again"))


def zip_positions(spark: SparkSession, d: str) -> D:
    p = A.pairs(spark, d, "frame_timestamps")
    z = p.select("run_id", "event_id", F.posexplode(F.arrays_zip(F.col("frame_timestamps").alias("ts"), F.transform("frame_timestamps", lambda t, i: F.format_string("frame_%03d", i + 1)).alias("frame"))).alias("ord", "z"))
    return z.select("run_id", "event_id", "ord", "z.ts", "z.frame")


QUERIES = {
    f.__name__: f
    for f in (
        chapter_mount, chapter_mount_once, chapter_overflow, chapter_lost, chapter_fallback_single, last_wins_bank, event_characters, timeline_text, chunk_summaries, bank_text,
        story_so_far, stage2_start_adjust, previous_caption, refine_progress, polish_payload, final_caption, storyboard_flat, token_by_stage, token_by_video, token_rollup,
        latest_runs, batch_status, discover_videos, sanitize_name, run_signature, run_dir, json_fence_clean, props_json, zip_positions,
    )
}

_T = P.seconds("ev.start_time")
_MOUNT = (
    f"{P.EVENTS},{P.CHAPTERS},cb AS (SELECT run_id,ch_idx,{P.seconds('start_time')} AS s,{P.seconds('end_time')} AS raw_e,ch_idx=max(ch_idx) OVER (PARTITION BY run_id) AS last FROM ch),"
    "ce AS (SELECT *,CASE WHEN last THEN raw_e+9999.0 ELSE raw_e END AS e FROM cb),"
    f"mt AS (SELECT ev.run_id,ch_idx,chunk_i,ev_i FROM ev JOIN ce ON ce.run_id=ev.run_id AND {_T}>=s-0.5 AND {_T}<e),"
    "mo AS (SELECT *,printf('ev_%02d_%03d',ch_idx+1,row_number() OVER (PARTITION BY run_id,ch_idx ORDER BY chunk_i,ev_i)) AS event_id FROM mt)"
)
_LATE = _MOUNT.replace("AS last FROM ch)", "AS last FROM (SELECT run_id,ch_idx,start_time,start_time AS end_time FROM ch WHERE ch_idx>0))")
_ONCE = "(SELECT run_id,chunk_i,ev_i,min(ch_idx) AS ch_idx FROM mt GROUP BY 1,2,3)"
_IN_LAST = "il AS (SELECT mo.run_id,count(*) AS n FROM mo JOIN ce USING (run_id,ch_idx) WHERE last GROUP BY 1)"
_LAST_BANK = f"{P.SIGHTINGS},lb AS (SELECT run_id,temp_name AS name,arg_max(struct_pack(x:=descr),struct_pack(a:=ch_idx,b:=ev_pos,c:=c_pos)).x AS descr FROM sg WHERE temp_name IS NOT NULL GROUP BY 1,2)"
_MENTIONS = (
    f"{P.PAIRS},mn AS (SELECT run_id,event_id,unnest(regexp_extract_all(COALESCE(step3_synthesized_dense_caption,''),'\\[[^\\[\\]]+\\]')) AS name,"
    "unnest(range(len(regexp_extract_all(COALESCE(step3_synthesized_dense_caption,''),'\\[[^\\[\\]]+\\]')))) AS k FROM pr),"
    "mu AS (SELECT run_id,event_id,name,min(k) AS k FROM mn GROUP BY 1,2,3)"
)
_FLAT = lambda x: f"trim(replace(COALESCE({x},''),chr(10),' '))"
_CALLS = (
    f"{P.PAIRS},ca AS (SELECT video_id,source AS stage,CASE WHEN frame_caption IS NOT NULL THEN length(step3_synthesized_dense_caption) END AS prompt_tokens,length(frame_caption) AS completion_tokens,"
    "length(step3_synthesized_dense_caption)+length(frame_caption) AS total_tokens FROM pr),"
    "cc AS (SELECT video_id,stage,COALESCE(prompt_tokens,0) AS p,COALESCE(completion_tokens,0) AS c,COALESCE(total_tokens,0) AS t FROM ca WHERE COALESCE(prompt_tokens,completion_tokens,total_tokens) IS NOT NULL)"
)
_SUMS = "CAST(sum(p) AS BIGINT) AS prompt_tokens,CAST(sum(c) AS BIGINT) AS completion_tokens,CAST(sum(t) AS BIGINT) AS total_tokens,count(*) AS calls"
_POLISHED = (
    "o AS (SELECT DISTINCT run_id,chapters FROM stage3_polished),oc AS (SELECT run_id,chapters,unnest(range(len(chapters))) AS ci FROM o),"
    "ob AS (SELECT run_id,ci,chapters[ci+1] AS c FROM oc WHERE chapters[ci+1] IS NOT NULL),oe AS (SELECT run_id,ci,c,unnest(range(len(c.events))) AS ei FROM ob),"
    "of AS (SELECT run_id,ci,c,ei,c.events[ei+1] AS e FROM oe WHERE c.events[ei+1] IS NOT NULL)"
)

SQL = {
    "chapter_mount": f"WITH {_MOUNT} SELECT run_id,ch_idx,chunk_i,ev_i,event_id FROM mo",
    "chapter_mount_once": f"WITH {_MOUNT} SELECT run_id,ch_idx,chunk_i,ev_i,printf('ev_%02d_%03d',ch_idx+1,row_number() OVER (PARTITION BY run_id,ch_idx ORDER BY chunk_i,ev_i)) AS event_id FROM {_ONCE}",
    "chapter_overflow": (
        f"WITH {_LATE},{_IN_LAST},sh AS (SELECT ev.run_id FROM ev WHERE run_id IN (SELECT run_id FROM ch WHERE ch_idx>0) GROUP BY 1 HAVING count(*)>COALESCE((SELECT count(*) FROM mo WHERE mo.run_id=ev.run_id),0))"
        f"SELECT ev.run_id,ch_idx,chunk_i,ev_i,printf('ev_fallback_%03d',COALESCE(n,0)+row_number() OVER (PARTITION BY ev.run_id ORDER BY chunk_i,ev_i)) AS event_id FROM ev JOIN ce ON ce.run_id=ev.run_id AND last AND {_T}>=raw_e"
        " LEFT JOIN il ON il.run_id=ev.run_id WHERE ev.run_id IN (SELECT run_id FROM sh)"
    ),
    "chapter_lost": (
        f"WITH {_MOUNT},{_IN_LAST} SELECT ev.run_id,ch_idx,chunk_i,ev_i,printf('ev_fallback_%03d',COALESCE(n,0)+row_number() OVER (PARTITION BY ev.run_id ORDER BY chunk_i,ev_i)) AS event_id FROM ev JOIN ce ON ce.run_id=ev.run_id AND last"
        " LEFT JOIN il ON il.run_id=ev.run_id WHERE NOT EXISTS (SELECT 1 FROM mt WHERE mt.run_id=ev.run_id AND mt.chunk_i=ev.chunk_i AND mt.ev_i=ev.ev_i)"
    ),
    "chapter_fallback_single": (
        f"WITH {P.EVENTS} SELECT run_id,0 AS ch_idx,'ch_01' AS chapter_id,arg_min(struct_pack(x:=start_time),struct_pack(a:=chunk_i,b:=ev_i)).x AS start_time,arg_max(struct_pack(x:=end_time),struct_pack(a:=chunk_i,b:=ev_i)).x AS end_time"
        " FROM ev WHERE run_id NOT IN (SELECT run_id FROM pass3_final) GROUP BY 1"
    ),
    "last_wins_bank": f"WITH {_LAST_BANK} SELECT * FROM lb",
    "event_characters": f"WITH {_LAST_BANK},{_MENTIONS} SELECT run_id,event_id,CAST(row_number() OVER (PARTITION BY run_id,event_id ORDER BY k)-1 AS INT) AS ord,name,COALESCE(descr,'') AS descr FROM mu LEFT JOIN lb USING (run_id,name)",
    "timeline_text": f"WITH {P.EVENTS} SELECT run_id,chunk_i,string_agg(COALESCE(start_time,'')||' - '||COALESCE(end_time,'')||' : '||COALESCE(step3_synthesized_dense_caption,''),chr(10) ORDER BY ev_i) AS text FROM ev GROUP BY 1,2",
    "chunk_summaries": (
        f"WITH {P.CHAPTERS} SELECT run_id,string_agg('Part '||(ch_idx+1)||' '||COALESCE(start_time,'?')||' - '||COALESCE(end_time,'?')||': '||COALESCE(nullif({_FLAT('chapter_summary')},''),'(no summary)'),chr(10) ORDER BY ch_idx) AS text FROM ch GROUP BY 1"
    ),
    "bank_text": f"WITH {_LAST_BANK} SELECT run_id,string_agg('- '||name||CASE WHEN {_FLAT('descr')}='' THEN '' ELSE ': '||{_FLAT('descr')} END,chr(10) ORDER BY name) AS text FROM lb GROUP BY 1",
    "story_so_far": (
        f"WITH {P.CHAPTERS} SELECT run_id,ch_idx,COALESCE(string_agg(nullif(trim(chapter_summary),''),chr(10)) OVER w,'') AS kept,COALESCE(string_agg('Part '||(ch_idx+1)||': '||COALESCE(chapter_summary,'')||chr(10),'') OVER w,'') AS all_lines"
        " FROM ch WINDOW w AS (PARTITION BY run_id ORDER BY ch_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ),
    "stage2_start_adjust": (
        f"WITH {P.PAIRS},x AS (SELECT run_id,event_id,{P.seconds('start_time')} AS start_sec,{P.seconds('end_time')} AS end_sec,ch_idx FROM pr),y AS (SELECT *,lag(end_sec) OVER (PARTITION BY run_id ORDER BY ch_idx,event_id) AS pe FROM x)"
        "SELECT run_id,event_id,start_sec,end_sec,CASE WHEN abs(start_sec-pe)<0.01 AND start_sec>0 THEN least(start_sec+0.5::DOUBLE,greatest(start_sec,end_sec-0.01::DOUBLE)) ELSE start_sec END AS actual_start FROM y WHERE end_sec>start_sec"
    ),
    "previous_caption": f"WITH {P.PAIRS} SELECT run_id,event_id,COALESCE(last_value(nullif(frame_caption,'') IGNORE NULLS) OVER (PARTITION BY run_id,ch_idx ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),'') AS previous FROM pr",
    "refine_progress": f"WITH {P.PAIRS} SELECT run_id,count(*) AS total,count(*) FILTER (COALESCE(frame_caption,'')<>'') AS done,count(*)-count(*) FILTER (COALESCE(frame_caption,'')<>'') AS remaining FROM pr GROUP BY 1",
    "polish_payload": (
        f"WITH {P.PAIRS},x AS (SELECT run_id,ch_idx,event_id,COALESCE(nullif(frame_caption,''),nullif(step3_synthesized_dense_caption,''),'') AS cap FROM pr)"
        "SELECT run_id,ch_idx,string_agg(event_id||'='||cap,chr(10) ORDER BY event_id) AS payload FROM x WHERE cap<>'' GROUP BY 1,2"
    ),
    "final_caption": (
        f"WITH {P.PAIRS},{_POLISHED},pl AS (SELECT run_id,e.event_id AS event_id,arg_max(e.final_caption,struct_pack(a:=ci,b:=ei)) AS polished FROM of WHERE COALESCE(e.event_id,'')<>'' AND COALESCE(e.final_caption,'')<>'' GROUP BY 1,2)"
        "SELECT run_id,event_id,COALESCE(nullif(polished,''),nullif(frame_caption,''),nullif(step3_synthesized_dense_caption,''),'') AS final_caption FROM pr LEFT JOIN pl USING (run_id,event_id)"
    ),
    "storyboard_flat": (
        f"WITH {_POLISHED} SELECT run_id,CAST(ci AS INT) AS ci,COALESCE(c.chapter_id,'') AS chapter_id,COALESCE(c.title,'') AS title,CAST(ei AS INT) AS ei,e.event_id,e.start_time,e.end_time,COALESCE(len(e.characters_in_event),0) AS n_characters FROM of"
    ),
    "token_by_stage": f"WITH {_CALLS} SELECT video_id,stage,{_SUMS} FROM cc GROUP BY 1,2",
    "token_by_video": f"WITH {_CALLS} SELECT video_id,{_SUMS} FROM cc GROUP BY 1",
    "token_rollup": f"WITH {_CALLS} SELECT video_id,stage,{_SUMS},CAST(grouping(video_id,stage) AS BIGINT) AS grain FROM cc GROUP BY GROUPING SETS ((video_id,stage),(video_id),(stage),())",
    "latest_runs": "SELECT video_id,run_id,status,error,config_hash FROM (SELECT DISTINCT * FROM runs) QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY started_at DESC NULLS LAST,run_id DESC)=1",
    "batch_status": "SELECT status,count(*) AS n_runs,count(DISTINCT video_id) AS n_videos,count(*) FILTER (ended_at IS NULL) AS n_open,count(error) AS n_errors FROM (SELECT DISTINCT * FROM runs) GROUP BY 1",
    "discover_videos": "SELECT video_id,path,lower(regexp_extract(path,'\\.[^./]*$')) AS ext FROM videos WHERE lower(regexp_extract(path,'\\.[^./]*$')) IN ('.mp4','.mkv','.avi','.mov','.webm','.flv')",
    "sanitize_name": "SELECT DISTINCT name,COALESCE(nullif(trim(regexp_replace(name,'[<>:\"/\\\\|?*\\x00-\\x1f]','_','g'),' .'),''),'unnamed') AS safe FROM (SELECT unnest([path,' .'||path||'?*. ',' . ']) AS name FROM videos)",
    "run_signature": "SELECT DISTINCT config_hash,'model_'||config_hash||'__chk60s__image_list__mf240__sc27_0__fw960__ovlp0' AS signature FROM runs",
    "run_dir": (
        "WITH p AS (SELECT DISTINCT unnest([path,path||'.part','/in/.'||ext,'in/'||video_id,'/in/a?.'||video_id||'.']) AS path FROM videos),b AS (SELECT path,list_last(string_split(path,'/')) AS n FROM p),"
        "c AS (SELECT path,n,string_split(n,'.') AS ps FROM b),s AS (SELECT path,CASE WHEN len(ps)>1 AND len(replace(array_to_string(ps[:len(ps)-1],'.'),'.',''))>0 THEN array_to_string(ps[:len(ps)-1],'.') ELSE n END AS stem FROM c)"
        "SELECT path,'/out/'||COALESCE(nullif(trim(regexp_replace(stem,'[<>:\"/\\\\|?*\\x00-\\x1f]','_','g'),' .'),''),'unnamed')||'/m__chk60s__image_list__mf240__sc27_0__fw960__ovlp0' AS run_dir FROM s"
    ),
    "json_fence_clean": (
        "WITH r AS (SELECT DISTINCT run_id,payload FROM raw_storyboards),x AS (SELECT run_id,0 AS form,'```json'||chr(10)||payload||chr(10)||'```' AS t FROM r UNION ALL SELECT run_id,1,' '||chr(10)||'```'||payload||'``` ' FROM r UNION ALL SELECT run_id,2,'note: '||payload FROM r),"
        "a AS (SELECT run_id,form,regexp_replace(t,'^\\s+|\\s+$','','g') AS t FROM x),b AS (SELECT run_id,form,CASE WHEN starts_with(t,'```json') THEN t[8:] WHEN starts_with(t,'```') THEN t[4:] ELSE t END AS t FROM a),"
        "c AS (SELECT run_id,form,CASE WHEN ends_with(t,'```') THEN t[:-4] ELSE t END AS t FROM b) SELECT run_id,form,md5(regexp_replace(t,'^\\s+|\\s+$','','g')) AS cleaned_md5 FROM c"
    ),
    "props_json": "SELECT event_id,CAST(json_extract(props,'$.k') AS BIGINT) AS k,'{\"k\":'||CAST(json_extract(props,'$.k') AS BIGINT)||'}' AS again FROM events",
    "zip_positions": (
        f"WITH {P.PAIRS},x AS (SELECT run_id,event_id,frame_timestamps,unnest(range(len(frame_timestamps))) AS k FROM pr) SELECT run_id,event_id,CAST(k AS INT) AS ord,frame_timestamps[k+1] AS ts,printf('frame_%03d',k+1) AS frame FROM x"
    ),
}
