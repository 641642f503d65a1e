"""A batch from a folder of videos to polished storyboards."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import ship
from ..functions import text as X
from ..operators import usage as U
from ..sources import storyboards
from ..sources.videos import discover
from . import media, model, relay, stages
from .config import Config
from .state import Workspace


_ANSWERS = ("relay/answers", "align/answers", "review/answers", "chapters/answers", "refine/answers", "polish/answers")


def _answers(ws: Workspace, *folders: str) -> DataFrame | None:
    """(video_id, stage, request_id, status, error, usage, seconds) of every
    round kept so far."""
    out = None
    for name in folders:
        if ws.exists(f"{ws.root}/{name}"):
            t = ws.spark.read.option("recursiveFileLookup", "true").parquet(f"{ws.root}/{name}").select("video_id", "stage", "request_id", "status", "error", "usage", "seconds")
            out = t if out is None else out.unionByName(t)
    return out


def run_batch(spark: SparkSession, cfg: Config, input_path: str, output: str, backend=None, decoder: media.Decoder | None = None) -> dict:
    """Run all stages for all videos under ``input_path``; the final tables and
    one document for each video stand under ``output``.

    A stage whose inputs and settings have not changed is not run again. A
    video that a failed call has ended is left out of the stages after it and
    listed in ``runs`` with the stage and its error; other videos go on. With
    strict failures off only calls without a way around end a video.
    ``calls`` holds every call with its attempts and seconds, ``summary.json``
    the numbers of the batch.
    """
    ship(spark)
    clock = datetime.now(UTC)
    began = clock.isoformat(timespec="seconds")
    decoder = decoder or media.OpenCvDecoder()
    backend = backend or model.HttpBackend(cfg.base_url, cfg.api_key, cfg.model_name, cfg.llm_timeout, cfg.max_retries)
    found = discover(spark, input_path, cfg.video_extensions)
    ws = Workspace(spark, f"{output.rstrip('/')}/{cfg.digest()}")
    ws.write_text(f"{ws.root}/settings.json", json.dumps(cfg.snapshot(), sort_keys=True))
    local = F.regexp_replace("path", "^file:/*", "/")
    listing = ws.put("listing", found.withColumn("path", local))
    if listing.isEmpty():
        return {"root": ws.root, "videos": 0}
    files = listing.agg(F.count(F.lit(1)), F.sum(F.xxhash64("video_id", "mtime", "length").cast("decimal(38,0)"))).first()
    d = cfg.digest()
    meta = ws.stage("video_meta", f"{d}|{files[0]}|{files[1]}", (), lambda: listing.select("video_id", "path").join(media.probe(listing, decoder), "video_id"))
    scene = None
    if cfg.input_payload_format == "image_list" and cfg.frame_extraction_strategy == "scenedetect":
        scene = ws.stage("scenes", d, ("video_meta",), lambda: media.scenes(meta.where("duration_sec is not null"), decoder, cfg.scene_detect_threshold))

    def perceived() -> DataFrame:
        relay.perceive(ws, meta.where("duration_sec is not null"), scene, decoder, backend, cfg)
        return ws.spark.read.parquet(f"{ws.root}/relay/state").groupBy("video_id").agg(F.max_by(F.struct("error", "at", "total"), "wave").alias("s")).select("video_id", "s.*")

    def going(t: DataFrame, *folders: str) -> DataFrame:
        """Rows of the videos that no failed call among the answers has ended."""
        answers = _answers(ws, *folders)
        return t if answers is None else t.join(stages.ended_by(answers, cfg), "video_id", "left_anti")

    status = ws.stage("perception", d, ("video_meta",), perceived)
    good = status.where("error is null").select("video_id")
    chunks, events, cand = (t.join(good, "video_id", "left_semi") for t in relay.collected(ws))

    def identities() -> DataFrame:
        ws.remove(f"{ws.root}/review")
        sightings, flags = stages.align(ws, chunks, cand, meta, decoder, backend, cfg)
        ws.put("sightings", going(sightings, "align/answers"))
        ws.put("low_confidence", flags)
        return stages.review(ws, ws.table("sightings"), meta, decoder, backend, cfg)

    final = ws.stage("people", d, ("perception",), identities)
    aligned = ws.stage("events_aligned", d, ("people",), lambda: going(stages.rewrite_captions(events, ws.table("sightings"), final), "align/answers", "review/answers"))

    def told() -> DataFrame:
        defs, mounted = stages.chapters(ws, chunks.join(aligned, "video_id", "left_semi"), aligned, final, backend, cfg)
        from pyspark.sql import Window as W

        n = F.row_number().over(W.partitionBy("video_id", "ch_idx").orderBy(F.col("event_id").startswith("ev_fallback"), "chunk_i", "ev_i"))
        whole = mounted.withColumn("ord", n).join(aligned.drop("chunk_time_range", "chunk_start", "chunk_end", "revised"), ["video_id", "chunk_i", "ev_i"])
        return going(whole, "chapters/answers")

    story = ws.stage("story", d, ("events_aligned",), told)
    defs = ws.table("chapters/defs")
    refined = ws.stage("refined", d, ("story",), lambda: going(stages.refine(ws, story, meta, decoder, backend, cfg), "refine/answers"))
    polished = ws.stage("polished", d, ("refined",), lambda: stages.characters(stages.polish(ws, refined, defs, backend, cfg), final))
    answers = _answers(ws, *_ANSWERS)
    u = answers.select("video_id", "stage", F.explode("usage").alias("u")).select("video_id", "stage", "u.*")
    usage = ws.put("usage", U.rollup(u))
    ws.put("calls", answers.select("video_id", "stage", "request_id", "status", "error", F.size("usage").alias("attempts"), "seconds"))
    late = stages.ended_by(answers.where("stage <> 'perception'"), cfg).select("video_id", F.concat_ws(": ", "stage", "error").alias("_late"))
    runs = meta.select("video_id", "path").join(status, "video_id", "left").join(late, "video_id", "left").withColumn("error", F.coalesce("error", "_late"))
    runs = runs.select("video_id", "path", F.when(F.col("total").isNull(), "unreadable").when(F.col("error").isNotNull(), "failed").otherwise("completed").alias("status"), "error")
    name = X.signature(F.lit(cfg.model_name), cfg.chunk_duration_sec, cfg.input_payload_format, cfg.max_frames_per_chunk, cfg.scene_detect_threshold, cfg.frame_max_width, cfg.prev_event_overlap_count)
    runs = runs.withColumn("run_dir", X.run_dir(F.lit(output), F.col("path"), name))
    runs = ws.put("runs", runs)
    # One row for each video and call of the batch is added, never replaced.
    log = runs.withColumns({"started_at": F.lit(began).cast("timestamp"), "ended_at": F.current_timestamp(), "config_hash": F.lit(d)})
    log.write.mode("append").parquet(f"{ws.root}/run_log")
    done = runs.where("status = 'completed'").select("video_id")
    summary = defs.groupBy("video_id").agg(F.max("video_summary").alias("video_summary"))
    shown = meta.join(done, "video_id", "left_semi").select("video_id", F.col("path").alias("video_path")).join(summary, "video_id", "left")
    ws.put("storyboards", storyboards.nest(polished, defs, shown))
    storyboards.write(ws.table("storyboards"), f"{ws.root}/documents")
    counts = {r["status"]: r["count"] for r in runs.groupBy("status").count().collect()}  # three rows at most
    tokens = usage.where("grain = 3").select("prompt_tokens", "completion_tokens", "total_tokens").first()
    out = {"root": ws.root, "videos": sum(counts.values()), "completed": counts.get("completed", 0)}
    ws.write_text(f"{ws.root}/summary.json", json.dumps(out | {"status": counts, "tokens": tokens.asDict() if tokens else {}, "seconds": round((datetime.now(UTC) - clock).total_seconds(), 3)}))
    return out
