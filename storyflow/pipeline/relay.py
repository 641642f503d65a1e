"""Perception in waves: the next stretch of a video begins where the model saw
the last event end, so one stretch of every unfinished video runs at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecode import format_seconds, parse_seconds
from ..operators import sampling as S
from ..operators import snap
from . import media, model, prompts
from .config import Config
from .state import Workspace

_EVENT = "struct<start_time:string,end_time:string,step1_objective_visual:string,step2_contextual_reasoning:string,step3_synthesized_dense_caption:string,key_frame_times:array<string>>"
_PERSON = "array<struct<temp_name:string,visual_description:string,anchor_timestamp:string>>"
PAYLOAD = (
    f"chunk_summary string, characters_in_chunk {_PERSON}, new_characters_in_chunk {_PERSON}, events array<{_EVENT}>, "
    "prev_event_revision struct<need_merge:boolean,start_time:string,end_time:string,step1_objective_visual:string,step2_contextual_reasoning:string,step3_synthesized_dense_caption:string,key_frame_times:array<string>>"
)


def _times(plan: DataFrame, scenes: DataFrame | None, cfg: Config) -> DataFrame:
    """Adds ``times`` to the plan of one wave."""
    if scenes is None or cfg.frame_extraction_strategy != "scenedetect":
        return plan.withColumn("times", S.uniform_times(F.col("chunk_start"), F.col("chunk_end"), cfg.max_frames_per_chunk))
    met = plan.join(scenes, "video_id", "left").withColumns({"s": F.greatest("start_sec", "chunk_start"), "e": F.least("end_sec", "chunk_end")}).where("s < e")
    alone = plan.join(met.select("video_id").distinct(), "video_id", "left_anti").select("video_id", F.lit(0).alias("scene_idx"), F.col("chunk_start").alias("s"), F.col("chunk_end").alias("e"))
    budget = S.frame_budget(met.select("video_id", "scene_idx", "s", "e").unionByName(alone), ["video_id"], cfg.max_frames_per_chunk)
    points = budget.select("video_id", F.explode(S.inner_points(F.col("s"), F.col("e"), F.col("alloc"))).alias("t"))
    return plan.join(points.groupBy("video_id").agg(F.array_sort(F.collect_set("t")).alias("times")), "video_id", "left")


def _context(history: Column, action: Column, end: Column) -> Column:
    told = F.when(F.size(history) > 0, F.array_join(history, "\n"))
    return F.coalesce(F.concat(F.coalesce(told, F.lit("Nothing yet.")), F.lit("\nThe last event was: "), action, F.lit(" It ended at "), end, F.lit(".")), F.lit("The video begins here."))


def perceive(ws: Workspace, videos: DataFrame, scenes: DataFrame | None, decoder: media.Decoder, backend, cfg: Config) -> int:
    """Run waves until every video is done; returns their number.

    Each wave leaves three tables: its answers, its events and the state after
    it. A batch that was broken off goes on after the last wave whose state is
    complete; waves of other videos or settings, as the stage's hash tells, are
    no part of it and are removed. A failed call ends its video if failures are
    strict, else the stretch is passed over.
    """
    spark = ws.spark
    ws.begin("relay", "perception")
    wave = 0
    while ws.exists(f"{ws.root}/relay/state/wave={wave}/_SUCCESS"):
        wave += 1
    if wave == 0:
        start = videos.where("duration_sec >= 1").select(
            "video_id", "path", F.floor("duration_sec").cast("double").alias("total"), F.lit(0.0).alias("at"), F.lit(0).alias("chunk_i"),
            F.array().cast("array<string>").alias("history"), F.lit(None).cast("string").alias("action"), F.lit(None).cast("string").alias("action_end"), F.lit(None).cast("string").alias("error"),
        )
        start.write.mode("overwrite").parquet(f"{ws.root}/relay/state/wave=0")
        wave = 1
    while True:
        state = spark.read.parquet(f"{ws.root}/relay/state/wave={wave - 1}")
        active = state.where("at < total and error is null")
        if active.isEmpty():
            return wave - 1
        _wave(ws, wave, state, active, scenes, decoder, backend, cfg)
        wave += 1


def _wave(ws: Workspace, wave: int, state: DataFrame, active: DataFrame, scenes: DataFrame | None, decoder: media.Decoder, backend, cfg: Config) -> None:
    base = f"{ws.root}/relay"
    length = float(cfg.chunk_duration_sec)
    plan = active.select("*", F.col("at").alias("chunk_start"), F.least(F.col("at") + length, F.col("total")).alias("chunk_end"))
    stretch = plan.select("video_id", "path", "chunk_start", "chunk_end")
    if cfg.input_payload_format == "video_base64":
        seen = ws.put(f"relay/clips/wave={wave}", media.clips(stretch, decoder, cfg.frame_max_width, cfg.target_fps))
        shots = seen.select("video_id", "times", F.array(model.video_part(F.col("mp4"))).alias("media"))
    else:
        frames = ws.put(f"relay/frames/wave={wave}", media.grab(_times(stretch, scenes, cfg), decoder, "video_id", cfg.frame_max_width, cfg.frame_jpg_quality))
        grouped = frames.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("ord", "ts", "jpeg"))).alias("shots"))
        pair = F.flatten(F.transform("shots", lambda x: F.array(model.text_part(F.concat(F.lit("Frame at "), format_seconds(x["ts"]))), model.image_part(x["jpeg"]))))
        shots = grouped.select("video_id", F.transform("shots", lambda x: x["ts"]).alias("times"), pair.alias("media"))
    span = F.concat(format_seconds(F.col("chunk_start")), F.lit(" - "), format_seconds(F.col("chunk_end")))
    asked = plan.join(shots, "video_id").withColumn("allowed", snap.whitelist(F.col("chunk_start"), F.col("times"))).withColumn("chunk_time_range", span)
    words = model.text_part(prompts.perceive(F.col("chunk_time_range"), F.col("allowed"), _context(F.col("history"), F.col("action"), F.col("action_end"))))
    rq = model.requests(asked, "perception", F.lit(prompts.PERCEIVE), F.concat("media", F.array(words)), cfg.llm_max_tokens, cfg.llm_temperature)
    ws.put(f"audit/perception/wave={wave}", model.audit(rq))
    answers = backend.call(rq)
    kept = rq.select("video_id", "chunk_i", "chunk_start", "chunk_end", "chunk_time_range", "allowed", "stage", "request_id").join(answers, "request_id")
    kept.write.mode("overwrite").parquet(f"{base}/answers/wave={wave}")
    got = ws.spark.read.parquet(f"{base}/answers/wave={wave}").withColumn("d", F.from_json("answer", PAYLOAD))
    ev = got.where("status = 'ok'").select("video_id", "chunk_i", "chunk_time_range", "chunk_start", "chunk_end", snap.timed(F.col("allowed")).alias("allowed"), F.posexplode("d.events").alias("ev_i", "e"))
    ev = ev.where("e is not null").select("video_id", "chunk_i", "chunk_time_range", "chunk_start", "chunk_end", "allowed", "ev_i", "e.*")
    snap.snap_events(ev).drop("allowed").write.mode("overwrite").parquet(f"{base}/events/wave={wave}")
    done = ws.spark.read.parquet(f"{base}/events/wave={wave}")
    last = done.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("ev_i", "start_time", "end_time", F.col("step3_synthesized_dense_caption").alias("cap")))).alias("es"))
    j = plan.join(got.select("video_id", F.col("status"), F.col("error").alias("_err"), F.trim(F.coalesce("d.chunk_summary", F.lit(""))).alias("summary")), "video_id", "left").join(last, "video_id", "left")
    end = F.element_at("es", -1)
    n = max(0, cfg.prev_event_overlap_count)
    anchor = parse_seconds(F.get("es", F.size("es") - F.least(F.lit(n), F.size("es")))["start_time"]) if n else None
    relay = snap.next_start(F.col("chunk_start"), F.col("chunk_end"), parse_seconds(end["end_time"]), anchor, length)
    step = F.when(F.col("status").isNull(), F.col("chunk_end")).when(F.col("es").isNotNull(), relay).otherwise(F.col("chunk_start") + 0.8 * length)
    finished = F.col("chunk_end") >= F.col("total") - 0.01
    failed = (F.col("status").isNotNull() & (F.col("status") != "ok")) if cfg.strict_failure else F.lit(False)
    told = F.col("es").isNotNull() & (F.col("summary") != "")
    line = F.concat(F.lit("Part "), (F.size("history") + 1).cast("string"), F.lit(": "), F.col("summary"))
    after = j.select(
        "video_id", "path", "total", F.when(finished, F.col("total")).otherwise(F.greatest(step, F.col("chunk_start") + 0.01)).alias("at"),
        F.when(F.col("status") == "ok", F.col("chunk_i") + 1).otherwise(F.col("chunk_i")).alias("chunk_i"),
        F.when(told, F.array_append("history", line)).otherwise(F.col("history")).alias("history"),
        F.coalesce(end["cap"], F.col("action")).alias("action"), F.coalesce(end["end_time"], F.col("action_end")).alias("action_end"),
        F.when(failed, F.coalesce("_err", F.col("status"))).alias("error"),
    )
    rest = state.join(plan.select("video_id"), "video_id", "left_anti")
    rest.unionByName(after).write.mode("overwrite").parquet(f"{base}/state/wave={wave}")


def collected(ws: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chunks, events after revisions, candidates) of all waves."""
    base = f"{ws.root}/relay"
    got = ws.spark.read.parquet(f"{base}/answers").where("status = 'ok'").withColumn("d", F.from_json("answer", PAYLOAD))
    chunks = got.select("video_id", "chunk_i", "chunk_time_range", "chunk_start", "chunk_end", "allowed", F.col("d.chunk_summary").alias("chunk_summary"))
    r = got.where("d.prev_event_revision is not null").select(
        "video_id", "chunk_i", F.coalesce("d.prev_event_revision.need_merge", F.lit(False)).alias("need_merge"), "d.prev_event_revision.start_time",
        F.when(F.coalesce("d.prev_event_revision.end_time", F.lit("")) != "", snap.nearest(snap.timed(F.col("allowed")), parse_seconds(F.col("d.prev_event_revision.end_time")))["txt"]).alias("end_time"),
        *[f"d.prev_event_revision.{c}" for c in snap.REVISED if c != "end_time"],
    )
    events = snap.apply_revisions(ws.spark.read.parquet(f"{base}/events").drop("wave"), r, "video_id")
    people = F.when(F.size("d.characters_in_chunk") > 0, F.col("d.characters_in_chunk")).otherwise(F.col("d.new_characters_in_chunk"))
    cand = got.select("video_id", "chunk_i", F.posexplode(people).alias("cand_i", "c")).where("c is not null")
    cand = cand.select("video_id", "chunk_i", "cand_i", "c.temp_name", F.col("c.visual_description").alias("descr"), F.col("c.anchor_timestamp").alias("anchor_ts"))
    return chunks, events, cand
