"""Registered queries about times: reading, planning, sampling, snapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import load
from ..functions import timecode as T
from ..operators import sampling as S
from ..operators import snap
from ..sources import adapters as A
from . import sqlparts as P

D = DataFrame


def ts_parse(spark: SparkSession, d: str) -> D:
    p = load(spark, d, "pass1_progress").select(F.explode(F.array("start_time", "end_time")).alias("ts"))
    return p.distinct().select("ts", T.parse_seconds(F.col("ts")).alias("sec"))


def _moments(spark: SparkSession, d: str) -> D:
    return load(spark, d, "stage2_refined").select(F.explode("frame_timestamps").alias("sec")).where("sec is not null").distinct()


def ts_format_sec(spark: SparkSession, d: str) -> D:
    return _moments(spark, d).select("sec", T.format_seconds(F.col("sec")).alias("txt"))


def ts_format_ms(spark: SparkSession, d: str) -> D:
    return _moments(spark, d).select("sec", T.format_millis(F.col("sec") + 0.9996).alias("txt"))


def _plan(spark: SparkSession, d: str) -> D:
    return S.chunk_plan(load(spark, d, "video_meta"), F.col("duration_sec"), ["video_id"])


def chunk_plan(spark: SparkSession, d: str) -> D:
    return _plan(spark, d)


def chunk_range_end(spark: SparkSession, d: str) -> D:
    e = A.chunk_bounds(load(spark, d, "pass1_progress").select("chunk_time_range").distinct())
    return e.select("chunk_time_range", "chunk_end")


def probe_duration(spark: SparkSession, d: str) -> D:
    m = load(spark, d, "video_meta")
    return m.select("video_id", F.when(F.col("fps") > 0, F.col("frame_count") / F.col("fps")).alias("duration"))


def _last_events(spark: SparkSession, d: str) -> D:
    e = A.events(spark, d, "start_time", "end_time", "chunk_time_range")
    last = e.groupBy("run_id", "chunk_i").agg(
        F.max_by("end_time", "ev_i").alias("end_time"), F.max_by("chunk_time_range", "ev_i").alias("chunk_time_range"),
        F.sort_array(F.collect_list(F.struct("ev_i", "start_time"))).alias("evs"),
    )
    return A.chunk_bounds(last)


def relay_decision(spark: SparkSession, d: str) -> D:
    e = _last_events(spark, d)
    end = T.parse_seconds(F.col("end_time"))
    anchor = T.parse_seconds(F.get("evs", F.size("evs") - F.least(F.lit(2), F.size("evs")))["start_time"])
    return e.select(
        "run_id", "chunk_i", "chunk_start", "chunk_end", end.alias("last_end"),
        snap.next_start(F.col("chunk_start"), F.col("chunk_end"), end).alias("next_start"),
        snap.next_start(F.col("chunk_start"), F.col("chunk_end"), end, anchor).alias("next_start_overlap"),
    )


def overlap_tail(spark: SparkSession, d: str) -> D:
    e = A.events(spark, d, "start_time", "end_time")
    return snap.tail(e, ["run_id", "chunk_i"], "ev_i", 3).select("run_id", "chunk_i", "ev_i", "start_time", "end_time")


def _scenes(spark: SparkSession, d: str) -> D:
    c = A.chapters(spark, d, "video_id", "start_time", "end_time")
    return c.groupBy("video_id", "start_time", "end_time").agg(F.lit(1).alias("_")).select(
        "video_id", F.concat_ws("|", "start_time", "end_time").alias("scene_idx"),
        T.parse_seconds(F.col("start_time")).alias("start_sec"), T.parse_seconds(F.col("end_time")).alias("end_sec"),
    )


def _clipped(spark: SparkSession, d: str) -> D:
    scenes = _scenes(spark, d)
    order = F.struct(F.lpad(F.col("start_sec").cast("decimal(18,6)").cast("string"), 20, "0").alias("a"), F.lpad(F.col("end_sec").cast("decimal(18,6)").cast("string"), 20, "0").alias("b"), F.col("scene_idx").alias("c"))
    return S.clip_scenes(scenes.withColumn("scene_idx", F.concat_ws("|", order["a"], order["b"], order["c"])), _plan(spark, d), "video_id")


def scene_clip(spark: SparkSession, d: str) -> D:
    return _clipped(spark, d).select("video_id", "chunk_i", F.col("scene_idx").cast("int").alias("scene_idx"), "s", "e")


def _budget(spark: SparkSession, d: str) -> D:
    return S.frame_budget(_clipped(spark, d), ["video_id", "chunk_i"], 240)


def frame_budget(spark: SparkSession, d: str) -> D:
    return _budget(spark, d).select("video_id", "chunk_i", F.col("scene_idx").cast("int").alias("scene_idx"), "alloc")


def frame_times(spark: SparkSession, d: str) -> D:
    t = S.frame_times(_budget(spark, d), ["video_id", "chunk_i"])
    return t.groupBy("video_id", "chunk_i").agg(F.count("ts").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def event_frame_times(spark: SparkSession, d: str) -> D:
    p = A.pairs(spark, d, "start_time", "end_time")
    s, e = T.parse_seconds(F.col("start_time")), T.parse_seconds(F.col("end_time"))
    p = p.select("run_id", "event_id", s.alias("s"), e.alias("e")).withColumn("n", S.event_frame_count(F.col("s"), F.col("e"), 1.0, 100)).where("n is not null")
    return p.select("run_id", "event_id", F.posexplode(S.inner_points(F.col("s"), F.col("e"), F.col("n"))).alias("ord", "ts"))


def frame_index(spark: SparkSession, d: str) -> D:
    p = A.pairs(spark, d, "video_id", "frame_timestamps")
    m = load(spark, d, "video_meta").select("video_id", "fps").where("fps is not null")
    x = p.select("video_id", "run_id", "event_id", F.posexplode("frame_timestamps").alias("ord", "ts")).where("ts is not null")
    return x.join(m, "video_id").select("run_id", "event_id", "ord", S.frame_index(F.col("ts"), F.col("fps")).alias("frame"))


def clip_frame_index(spark: SparkSession, d: str) -> D:
    m = load(spark, d, "video_meta").select("video_id", "fps").where("fps > 0")
    c = _plan(spark, d).join(m, "video_id")
    return c.select("video_id", "chunk_i", F.explode(S.clip_frames(F.col("chunk_start"), F.col("chunk_end"), F.col("fps"), 1.0)).alias("frame"))


def resize_dims(spark: SparkSession, d: str) -> D:
    m = load(spark, d, "video_meta").where("width is not null and height is not null")
    w, h = S.shrink(F.col("width"), F.col("height"), 960)
    return m.select("video_id", w.cast("int").alias("w"), h.cast("int").alias("h"))


def _allowed(spark: SparkSession, d: str) -> D:
    e = A.chunk_bounds(load(spark, d, "pass1_progress").select("run_id", "chunk_i", "chunk_time_range").distinct())
    one = e.groupBy("run_id", "chunk_i").agg(F.max(F.struct("chunk_end", "chunk_start")).alias("b")).select("run_id", "chunk_i", "b.chunk_start", "b.chunk_end")
    return one.withColumn("allowed", snap.whitelist(F.col("chunk_start"), S.uniform_times(F.col("chunk_start"), F.col("chunk_end"), 13)))


def chunk_whitelist(spark: SparkSession, d: str) -> D:
    return _allowed(spark, d).select("run_id", "chunk_i", F.posexplode("allowed").alias("ord", "txt"))


def _snapped(spark: SparkSession, d: str) -> D:
    e = A.events(spark, d, "start_time", "end_time", "key_frame_times")
    chunks = _allowed(spark, d).withColumn("allowed", snap.timed(F.col("allowed")))
    return snap.snap_events(e.join(chunks, ["run_id", "chunk_i"]))


def event_snap(spark: SparkSession, d: str) -> D:
    return _snapped(spark, d).select("run_id", "chunk_i", "ev_i", "start_time", "end_time")


def keyframe_violations(spark: SparkSession, d: str) -> D:
    e = A.events(spark, d, "start_time", "end_time", "key_frame_times")
    bad = snap.outside_key_frames(F.col("key_frame_times"), F.col("start_time"), F.col("end_time"))
    return e.select("run_id", "chunk_i", "ev_i", F.size(bad).cast("bigint").alias("n_outside")).where("n_outside > 0")


def revision_merge(spark: SparkSession, d: str) -> D:
    from pyspark.sql import Window as W

    e = A.events(spark, d, "start_time", *snap.REVISED)
    edge = e.groupBy("run_id", "chunk_i").agg(
        F.max_by(F.struct("start_time"), "ev_i").alias("lst"), F.min_by(F.struct("start_time", "end_time"), "ev_i").alias("fst")
    )
    w = W.partitionBy("run_id").orderBy("chunk_i")
    r = edge.withColumn("_prev", F.lag("lst").over(w)).where("_prev is not null").select(
        "run_id", "chunk_i", (F.col("chunk_i") % 3 != 0).alias("need_merge"),
        F.when(F.col("chunk_i") % 4 != 0, F.col("_prev.start_time")).otherwise(F.col("fst.start_time")).alias("start_time"),
        F.when(F.col("chunk_i") % 5 != 0, F.col("fst.end_time")).alias("end_time"),
        F.when(F.col("chunk_i") % 2 == 0, F.concat(F.lit("revised by chunk "), F.col("chunk_i").cast("string"))).alias("step3_synthesized_dense_caption"),
        F.when(F.col("chunk_i") % 7 < 4, F.concat(F.lit("seen by chunk "), F.col("chunk_i").cast("string"))).alias("step1_objective_visual"),
        F.when(F.col("chunk_i") % 7 > 2, F.concat(F.lit("reasoned by chunk "), F.col("chunk_i").cast("string"))).alias("step2_contextual_reasoning"),
        F.when(F.col("chunk_i") % 4 == 1, F.array(F.col("fst.start_time"))).alias("key_frame_times"),
    )
    out = snap.apply_revisions(e, r).withColumn("key_frame_times", F.array_join("key_frame_times", ",", "-"))
    return out.select("run_id", "chunk_i", "ev_i", "start_time", *snap.REVISED[:3], F.col("step3_synthesized_dense_caption").alias("caption"), "key_frame_times", "revised")


def timeline_gaps(spark: SparkSession, d: str) -> D:
    return snap.timeline_gaps(A.events(spark, d, "start_time", "end_time"), "run_id", ["chunk_i", "ev_i"])


QUERIES = {
    f.__name__: f
    for f in (
        ts_parse, ts_format_sec, ts_format_ms, chunk_plan, chunk_range_end, probe_duration, relay_decision, overlap_tail, scene_clip, frame_budget,
        frame_times, event_frame_times, frame_index, clip_frame_index, resize_dims, chunk_whitelist, event_snap, keyframe_violations, revision_merge, timeline_gaps,
    )
}

_MOMENTS = "m AS (SELECT DISTINCT sec FROM (SELECT unnest(frame_timestamps) AS sec FROM stage2_refined) WHERE sec IS NOT NULL)"
_PLAN = (
    "pl AS (SELECT video_id,CAST(k AS INT) AS chunk_i,k*60.0::DOUBLE AS chunk_start,least((k+1)*60.0::DOUBLE,t) AS chunk_end FROM "
    "(SELECT video_id,t,unnest(range(CAST(ceil(t/60) AS BIGINT))) AS k FROM (SELECT video_id,CAST(floor(duration_sec) AS DOUBLE) AS t FROM video_meta) WHERE t>=1))"
)
_RANGE = lambda i: P.seconds(f"(string_split(chunk_time_range,' - '))[{i}]")
_BOUNDS = (
    f"b AS (SELECT run_id,chunk_i,max(struct_pack(e:={_RANGE(2)},s:={_RANGE(1)})) AS x FROM pass1_progress GROUP BY 1,2),"
    "bb AS (SELECT run_id,chunk_i,x.s AS chunk_start,x.e AS chunk_end FROM b)"
)
_CLIP = (
    f"{_PLAN},{P.CHAPTERS},sc AS (SELECT DISTINCT video_id,start_time,end_time,{P.seconds('start_time')} AS s0,{P.seconds('end_time')} AS e0 FROM ch),"
    "cl AS (SELECT pl.video_id,chunk_i,chunk_start,chunk_end,greatest(s0,chunk_start) AS s,least(e0,chunk_end) AS e,s0,e0,concat_ws('|',start_time,end_time) AS id"
    " FROM pl JOIN sc ON sc.video_id=pl.video_id AND greatest(s0,chunk_start)<least(e0,chunk_end)),"
    "al AS (SELECT video_id,chunk_i,CAST(row_number() OVER (PARTITION BY video_id,chunk_i ORDER BY s0,e0,id)-1 AS INT) AS scene_idx,s,e FROM cl"
    " UNION ALL SELECT video_id,chunk_i,0,chunk_start,chunk_end FROM pl WHERE NOT EXISTS (SELECT 1 FROM cl WHERE cl.video_id=pl.video_id AND cl.chunk_i=pl.chunk_i))"
)
_WANT = (
    f"{_CLIP},tt AS (SELECT video_id,chunk_i,sum(e-s) AS total,max(scene_idx) AS last FROM al GROUP BY 1,2),"
    "wa AS (SELECT al.*,last,greatest(1,CAST(round_even((e-s)/(CASE WHEN total=0 THEN 1e-5 ELSE total END)*240,0) AS INT)) AS want FROM al JOIN tt USING (video_id,chunk_i)),"
    "bu AS (SELECT video_id,chunk_i,scene_idx,s,e,CAST(CASE WHEN scene_idx=last THEN 240-b ELSE u-b END AS INT) AS alloc FROM (SELECT *,"
    "least(240,sum(want) OVER (PARTITION BY video_id,chunk_i ORDER BY scene_idx)) AS u,"
    "least(240,COALESCE(sum(want) OVER (PARTITION BY video_id,chunk_i ORDER BY scene_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0)) AS b FROM wa))"
)
_ALLOWED = (
    f"{_BOUNDS},tm AS (SELECT run_id,chunk_i,chunk_start,chunk_end,{P.clock('chunk_start+(chunk_end-chunk_start)*k/12')} AS txt FROM bb,range(13) r(k)),"
    f"al AS (SELECT DISTINCT run_id,chunk_i,chunk_start,chunk_end,txt,1 AS pre FROM tm UNION SELECT DISTINCT run_id,chunk_i,chunk_start,chunk_end,{P.clock('chunk_start')},0 FROM bb"
    f" WHERE NOT EXISTS (SELECT 1 FROM tm WHERE tm.run_id=bb.run_id AND tm.chunk_i=bb.chunk_i AND tm.txt={P.clock('bb.chunk_start')}))"
)
_LAST = (
    f"{P.EVENTS},la AS (SELECT run_id,chunk_i,arg_max(struct_pack(t:=end_time),ev_i).t AS end_time,arg_max(struct_pack(t:=chunk_time_range),ev_i).t AS chunk_time_range,"
    "list(struct_pack(t:=start_time) ORDER BY ev_i) AS evs FROM ev GROUP BY 1,2),"
    f"lb AS (SELECT *,{_RANGE(1)} AS chunk_start,{_RANGE(2)} AS chunk_end,{P.seconds('end_time')} AS last_end,{P.seconds('evs[greatest(len(evs)-1,1)].t')} AS anchor FROM la)"
)
_NEXT = "CASE WHEN last_end>=chunk_start+5 AND last_end<=chunk_end+10 THEN {} ELSE chunk_start+0.8::DOUBLE*60 END"

SQL = {
    "ts_parse": f"SELECT ts,{P.seconds('ts')} AS sec FROM (SELECT DISTINCT unnest([start_time,end_time]) AS ts FROM pass1_progress)",
    "ts_format_sec": f"WITH {_MOMENTS} SELECT sec,{P.clock('sec')} AS txt FROM m",
    "ts_format_ms": (
        f"WITH {_MOMENTS},x AS (SELECT sec,floor(sec+0.9996::DOUBLE) AS w,CAST(round_even((sec+0.9996::DOUBLE-floor(sec+0.9996::DOUBLE))*1000,0) AS BIGINT) AS ms FROM m),"
        "y AS (SELECT sec,CAST(w AS BIGINT)+CASE WHEN ms>=1000 THEN 1 ELSE 0 END AS s,CASE WHEN ms>=1000 THEN 0 ELSE ms END AS ms FROM x)"
        "SELECT sec,printf('[%02d:%02d:%02d.%03d]',s//3600,(s%3600)//60,s%60,ms) AS txt FROM y"
    ),
    "chunk_plan": f"WITH {_PLAN} SELECT * FROM pl",
    "chunk_range_end": f"SELECT DISTINCT chunk_time_range,{_RANGE(2)} AS chunk_end FROM pass1_progress",
    "probe_duration": "SELECT video_id,CASE WHEN fps>0 THEN frame_count/fps END AS duration FROM video_meta",
    "relay_decision": (
        f"WITH {_LAST} SELECT run_id,chunk_i,chunk_start,chunk_end,last_end,{_NEXT.format('last_end')} AS next_start,"
        f"{_NEXT.format('CASE WHEN anchor>chunk_start+1.0 THEN anchor ELSE last_end END')} AS next_start_overlap FROM lb"
    ),
    "overlap_tail": f"WITH {P.EVENTS} SELECT run_id,chunk_i,ev_i,start_time,end_time FROM ev QUALIFY row_number() OVER (PARTITION BY run_id,chunk_i ORDER BY ev_i DESC)<=3",
    "scene_clip": f"WITH {_CLIP} SELECT * FROM al",
    "frame_budget": f"WITH {_WANT} SELECT video_id,chunk_i,scene_idx,alloc FROM bu",
    "frame_times": f"WITH {_WANT} SELECT video_id,chunk_i,count(DISTINCT s+(e-s)*k/(alloc+1)) AS n,min(s+(e-s)*k/(alloc+1)) AS first_ts,max(s+(e-s)*k/(alloc+1)) AS last_ts FROM (SELECT *,unnest(range(1,alloc+1)) AS k FROM bu WHERE alloc>0) GROUP BY 1,2",
    "event_frame_times": (
        f"WITH {P.PAIRS},x AS (SELECT run_id,event_id,{P.seconds('start_time')} AS s,{P.seconds('end_time')} AS e FROM pr),"
        "y AS (SELECT *,least(greatest(1,CAST(round_even(e-s,0) AS INT)),100) AS n FROM x WHERE e>s)"
        "SELECT run_id,event_id,CAST(k-1 AS INT) AS ord,s+(e-s)*k/(n+1) AS ts FROM (SELECT *,unnest(range(1,n+1)) AS k FROM y)"
    ),
    "frame_index": (
        f"WITH {P.PAIRS},x AS (SELECT video_id,run_id,event_id,frame_timestamps,unnest(range(len(frame_timestamps))) AS k FROM pr)"
        "SELECT run_id,event_id,CAST(k AS INT) AS ord,CAST(trunc(frame_timestamps[k+1]*fps) AS BIGINT) AS frame FROM x JOIN video_meta USING (video_id) WHERE fps IS NOT NULL AND frame_timestamps[k+1] IS NOT NULL"
    ),
    "clip_frame_index": (
        f"WITH {_PLAN} SELECT video_id,chunk_i,unnest(range(CAST(trunc(chunk_start*fps) AS BIGINT),CAST(trunc(chunk_end*fps) AS BIGINT)+1,greatest(1,CAST(round_even(fps/1.0,0) AS BIGINT)))) AS frame"
        " FROM pl JOIN video_meta USING (video_id) WHERE fps>0"
    ),
    "resize_dims": (
        "SELECT video_id,CASE WHEN width<=960 THEN CAST(width AS INT) ELSE CAST(trunc(width*least(1.0::DOUBLE,960.0::DOUBLE/width)) AS INT) END AS w,"
        "CASE WHEN width<=960 THEN CAST(height AS INT) ELSE CAST(trunc(height*least(1.0::DOUBLE,960.0::DOUBLE/width)) AS INT) END AS h FROM video_meta WHERE width IS NOT NULL AND height IS NOT NULL"
    ),
    "chunk_whitelist": f"WITH {_ALLOWED} SELECT run_id,chunk_i,CAST(row_number() OVER (PARTITION BY run_id,chunk_i ORDER BY pre,txt)-1 AS INT) AS ord,txt FROM al",
    "event_snap": (
        f"WITH {P.EVENTS},{_ALLOWED},w AS (SELECT *,{P.seconds('txt')} AS sec FROM al),"
        f"q AS (SELECT run_id,chunk_i,ev_i,{P.seconds('start_time')} AS ts,{P.seconds('end_time')} AS te FROM ev),"
        "n AS (SELECT q.run_id,q.chunk_i,ev_i,any_value(chunk_start) AS chunk_start,any_value(chunk_end) AS chunk_end,"
        "min(struct_pack(d:=CASE WHEN abs(sec-ts)<0.01 THEN -1 ELSE abs(sec-ts) END,sec:=sec,txt:=txt)) AS a,min(struct_pack(d:=CASE WHEN abs(sec-te)<0.01 THEN -1 ELSE abs(sec-te) END,sec:=sec,txt:=txt)) AS b"
        " FROM q JOIN w USING (run_id,chunk_i) GROUP BY 1,2,3),"
        "t AS (SELECT run_id,chunk_i,ev_i,chunk_start,chunk_end,CASE WHEN a.sec>b.sec THEN b ELSE a END AS s,CASE WHEN a.sec>b.sec THEN a ELSE b END AS e FROM n),"
        "k AS (SELECT run_id,chunk_i,arg_min(txt,sec) FILTER (sec>=chunk_start-0.1) AS lo,arg_max(txt,sec) FILTER (sec<=chunk_end+0.1) AS hi FROM w GROUP BY 1,2)"
        "SELECT t.run_id,t.chunk_i,ev_i,CASE WHEN s.sec<chunk_start-0.5 THEN COALESCE(lo,s.txt) ELSE s.txt END AS start_time,"
        "CASE WHEN e.sec>chunk_end+0.5 THEN COALESCE(hi,e.txt) ELSE e.txt END AS end_time FROM t JOIN k USING (run_id,chunk_i) WHERE e.sec-s.sec>=0.1"
    ),
    "keyframe_violations": (
        f"WITH {P.EVENTS},x AS (SELECT run_id,chunk_i,ev_i,{P.seconds('start_time')} AS s,{P.seconds('end_time')} AS e,unnest(key_frame_times) AS k FROM ev)"
        f"SELECT run_id,chunk_i,ev_i,count(*) AS n_outside FROM (SELECT *,{P.seconds('k')} AS t FROM x WHERE k IS NOT NULL) WHERE t<s-0.1 OR t>e+0.1 GROUP BY 1,2,3"
    ),
    "revision_merge": (
        f"WITH {P.EVENTS},g AS (SELECT run_id,chunk_i,max(ev_i) AS last_i,arg_max(struct_pack(s:=start_time),ev_i) AS l,arg_min(struct_pack(s:=start_time,e:=end_time),ev_i) AS f FROM ev GROUP BY 1,2),"
        "h AS (SELECT *,lag(l) OVER w AS p,lag(chunk_i) OVER w AS pc,lag(last_i) OVER w AS pi FROM g WINDOW w AS (PARTITION BY run_id ORDER BY chunk_i)),"
        "r AS (SELECT run_id,pc AS chunk_i,pi AS ev_i,CASE WHEN chunk_i%4<>0 THEN p.s ELSE f.s END AS rs,CASE WHEN chunk_i%5<>0 THEN f.e END AS re,"
        "CASE WHEN chunk_i%2=0 THEN 'revised by chunk '||chunk_i END AS rc,CASE WHEN chunk_i%7<4 THEN 'seen by chunk '||chunk_i END AS r1,"
        "CASE WHEN chunk_i%7>2 THEN 'reasoned by chunk '||chunk_i END AS r2,CASE WHEN chunk_i%4=1 THEN [f.s] END AS rk FROM h WHERE pc IS NOT NULL AND chunk_i%3<>0),"
        f"j AS (SELECT ev.*,re,rc,r1,r2,rk,COALESCE(rs IS NOT NULL AND abs({P.seconds('start_time')}-{P.seconds('rs')})<=0.01,false) AS revised FROM ev LEFT JOIN r USING (run_id,chunk_i,ev_i))"
        "SELECT run_id,chunk_i,ev_i,start_time,CASE WHEN revised THEN COALESCE(re,end_time) ELSE end_time END AS end_time,"
        "CASE WHEN revised THEN COALESCE(r1,step1_objective_visual) ELSE step1_objective_visual END AS step1_objective_visual,"
        "CASE WHEN revised THEN COALESCE(r2,step2_contextual_reasoning) ELSE step2_contextual_reasoning END AS step2_contextual_reasoning,"
        "CASE WHEN revised THEN COALESCE(rc,step3_synthesized_dense_caption) ELSE step3_synthesized_dense_caption END AS caption,"
        "array_to_string(list_transform(CASE WHEN revised THEN COALESCE(rk,key_frame_times) ELSE key_frame_times END,lambda k: COALESCE(k,'-')),',') AS key_frame_times,revised FROM j"
    ),
    "timeline_gaps": (
        f"WITH {P.EVENTS},x AS (SELECT run_id,chunk_i,ev_i,{P.seconds('end_time')} AS end_sec,lead({P.seconds('start_time')}) OVER (PARTITION BY run_id ORDER BY chunk_i,ev_i) AS next_start_sec FROM ev)"
        "SELECT *,next_start_sec-end_sec AS gap_sec FROM x WHERE abs(next_start_sec-end_sec)>=0.01"
    ),
}
