"""Registered queries of the general training-data operators (problems 2 and 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..common import load
from ..operators import intervals, nested
from ..sources.adapters import FINAL_ITEMS, POLISHED_KEYS


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.all_children(
        load(spark, sf_dir, "stage3_polished", POLISHED_KEYS), load(spark, sf_dir, "pass3_final", FINAL_ITEMS), load(spark, sf_dir, "raw_storyboards")
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = intervals.level_intervals(load(spark, sf_dir, "pass1_progress"))
    return intervals.periods_and_gaps(both, ["run_id", "level"], "a", "b")


_READABLE = "regexp_full_match({0},'[0-9]{{2,}}:[0-5][0-9]:[0-5][0-9](\\.[0-9]{{1,3}})?')"
_EDGE = "' '||chr(9)||chr(10)||chr(13)||chr(160)||chr(12288)||chr(65279)||'[](){}【】「」（）'"


def _ms(t: str) -> str:
    """Milliseconds of a time text that is readable as it stands."""
    p = f"string_split_regex({t},'[:.]')"
    return f"(CAST(({p})[1] AS BIGINT)*3600000+CAST(({p})[2] AS BIGINT)*60000+CAST(({p})[3] AS BIGINT)*1000+COALESCE(CAST(rpad(({p})[4],3,'0') AS BIGINT),0))"


def _strict(x: str) -> str:
    t = f"trim({x},{_EDGE})"
    return f"CASE WHEN {_READABLE.format(t)} THEN {_ms(t)} END"


_BOTH = "regexp_extract_all(' '||regexp_replace(chunk_time_range,'[-–—]','  ','g')||' ','[^0-9:.]([0-9]{2,}:[0-5][0-9]:[0-5][0-9](?:\\.[0-9]{1,3})?)[^0-9:.]',1)"
_ELEMENTS = "CASE WHEN {0} IS NULL OR json_type({0})='NULL' THEN [] WHEN json_type({0})='ARRAY' THEN CAST({0} AS JSON[]) ELSE [{0}] END"
_TEXT = "CASE WHEN json_type({0})='VARCHAR' THEN {0}->>'$' ELSE '' END"


def _level(name: str, source: str, keep: str, child: str) -> str:
    """One level of JSON children with their positions."""
    e = _ELEMENTS.format(child)
    return f"{name} AS (SELECT * FROM (SELECT {keep},unnest({e}) AS x,unnest(range(len({e}))) AS i FROM {source}) WHERE x IS NOT NULL AND json_type(x)<>'NULL')"


SQL = {
    "p2_found": (
        "WITH s3 AS (SELECT DISTINCT run_id,chapters FROM stage3_polished),c3 AS (SELECT run_id,unnest(chapters) AS c,unnest(range(len(chapters))) AS ci FROM s3),"
        "e3 AS (SELECT run_id,ci,unnest(c.events) AS e,unnest(range(len(c.events))) AS ei FROM c3 WHERE c IS NOT NULL),"
        "p3 AS (SELECT DISTINCT run_id,ch_idx,events FROM pass3_final),q3 AS (SELECT run_id,ch_idx,unnest(events) AS e,unnest(range(len(events))) AS ei FROM p3),"
        "h3 AS (SELECT run_id,ch_idx,ei,unnest(e.characters_in_event) AS p,unnest(range(len(e.characters_in_event))) AS i FROM q3 WHERE e IS NOT NULL),"
        "k3 AS (SELECT run_id,ch_idx,ei,unnest(e.key_frame_times) AS k,unnest(range(len(e.key_frame_times))) AS i FROM q3 WHERE e IS NOT NULL),"
        "r0 AS (SELECT DISTINCT run_id,trim(ltrim(payload,chr(65279)),' '||chr(9)||chr(10)||chr(13)) AS t FROM raw_storyboards),"
        "r1 AS (SELECT run_id,CAST(CASE WHEN json_valid(t) THEN t END AS JSON) AS j FROM r0),r2 AS (SELECT run_id,j->'$.chapters' AS cs FROM r1 WHERE j IS NOT NULL AND json_type(j)='OBJECT'),"
        + _level("rc", "r2", "run_id", "cs") + ","
        + _level("re0", "(SELECT run_id,i AS ci,x->'$.events' AS es FROM rc)", "run_id,ci", "es") + ","
        + _level("rh", "(SELECT run_id,ci,i AS ei,x->'$.characters_in_event' AS hs FROM re0)", "run_id,ci,ei", "hs") + ","
        + _level("rk", "(SELECT run_id,ci,i AS ei,x->'$.key_frame_times' AS ks FROM re0)", "run_id,ci,ei", "ks")
        + ",u AS (SELECT 'stage3_polished' AS tbl,'chapter' AS level,run_id,ci AS chapter_pos,-1 AS event_pos,-1 AS item_pos,COALESCE(c.chapter_id,'') AS child_key FROM c3 WHERE c IS NOT NULL"
        " UNION ALL SELECT 'stage3_polished','event',run_id,ci,ei,-1,COALESCE(e.event_id,'') FROM e3 WHERE e IS NOT NULL"
        " UNION ALL SELECT 'pass3_final','character',run_id,ch_idx,ei,i,COALESCE(p.name,'') FROM h3 WHERE p IS NOT NULL"
        " UNION ALL SELECT 'pass3_final','key_frame',run_id,ch_idx,ei,i,k FROM k3 WHERE k IS NOT NULL"
        f" UNION ALL SELECT 'raw_storyboards','chapter',run_id,i,-1,-1,COALESCE({_TEXT.format("(x->'$.chapter_id')")},'') FROM rc"
        f" UNION ALL SELECT 'raw_storyboards','event',run_id,ci,i,-1,COALESCE({_TEXT.format("(x->'$.event_id')")},'') FROM re0"
        f" UNION ALL SELECT 'raw_storyboards','character',run_id,ci,ei,i,COALESCE({_TEXT.format("(x->'$.name')")},'') FROM rh"
        f" UNION ALL SELECT 'raw_storyboards','key_frame',run_id,ci,ei,i,{_TEXT.format('x')} FROM rk)"
        " SELECT DISTINCT tbl,level,run_id,CAST(chapter_pos AS INT) AS chapter_pos,CAST(event_pos AS INT) AS event_pos,CAST(item_pos AS INT) AS item_pos,child_key FROM u"
    ),
    "p4_found": (
        f"WITH iv AS (SELECT run_id,'event' AS level,{_strict('start_time')} AS a,{_strict('end_time')} AS b FROM pass1_progress"
        f" UNION ALL SELECT run_id,'chunk',CASE WHEN len({_BOTH})=2 THEN {_ms(f'({_BOTH})[1]')} END,CASE WHEN len({_BOTH})=2 THEN {_ms(f'({_BOTH})[2]')} END FROM pass1_progress),"
        "o AS (SELECT DISTINCT run_id,level,least(a,b) AS s,greatest(a,b) AS e FROM iv WHERE a IS NOT NULL AND b IS NOT NULL AND a<>b),"
        "m AS (SELECT *,max(e) OVER (PARTITION BY run_id,level ORDER BY s,e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM o),"
        "n AS (SELECT *,sum(CASE WHEN reach>=s THEN 0 ELSE 1 END) OVER (PARTITION BY run_id,level ORDER BY s,e ROWS UNBOUNDED PRECEDING) AS isl FROM m),"
        "p AS (SELECT run_id,level,min(s) AS s,max(e) AS e FROM n GROUP BY run_id,level,isl),g AS (SELECT *,lag(e) OVER (PARTITION BY run_id,level ORDER BY s) AS pe FROM p)"
        "SELECT run_id,level,'period' AS kind,s AS start_ms,e AS end_ms FROM p UNION ALL SELECT run_id,level,'gap',pe,s FROM g WHERE pe IS NOT NULL"
    ),
}

QUERIES = {"p2_found": p2_found, "p4_found": p4_found}
