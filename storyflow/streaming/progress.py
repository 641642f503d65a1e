"""Progress rows as a stream: each event once, counts by window, and the rolling
cluster fold with its state in Spark's state store."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.timecode import parse_seconds
from ..operators.identity import FLAG_BELOW, SPLIT_BELOW

PROGRESS = (
    "video_id string, run_id string, chunk_i int, ev_i int, chunk_time_range string, start_time string, end_time string, step1_objective_visual string, "
    "step2_contextual_reasoning string, step3_synthesized_dense_caption string, key_frame_times array<string>, ingested_at timestamp_ntz"
)


def read_progress(spark: SparkSession, path: str, max_files: int = 64) -> DataFrame:
    """New parquet files of a folder as they arrive."""
    return spark.readStream.schema(PROGRESS).option("maxFilesPerTrigger", max_files).parquet(path)


def first_deliveries(progress: DataFrame, lateness: str = "90 days") -> DataFrame:
    """Each event once: a row delivered again within the lateness is dropped,
    and its key is forgotten after that, so the state stays bounded. Rows that
    arrive later than that behind the newest are not taken; the batch readers
    take all."""
    e = progress.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    return e.withWatermark("ingested_at", lateness).dropDuplicatesWithinWatermark(["run_id", "chunk_i", "ev_i"])


def arrivals(progress: DataFrame, window: str = "1 hour", lateness: str = "90 days") -> DataFrame:
    """(start, end, n_events, seconds): what arrived in each window."""
    e = progress.withColumn("ingested_at", F.col("ingested_at").cast("timestamp")).withWatermark("ingested_at", lateness)
    length = F.greatest(F.lit(0.0), parse_seconds(F.col("end_time")) - parse_seconds(F.col("start_time")))
    return e.groupBy(F.window("ingested_at", window).alias("w")).agg(F.count(F.lit(1)).alias("n_events"), F.sum(length).alias("seconds")).select("w.start", "w.end", "n_events", "seconds")


def write_deduplicated(progress: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append first deliveries to parquet, exactly once, and stop when all that
    is there now has been read."""
    return (
        first_deliveries(progress).writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )


FOLD_OUT = "run_id string, p int, cluster_id string, is_new boolean, low_conf boolean"
_NUMBER = re.compile(r"cluster_([0-9]{4,})\Z")


def _fold(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState, split_below: float, flag_below: float) -> Iterator[pd.DataFrame]:
    made = state.get[0] if state.exists else 0
    out = []
    for p, match, conf in sorted(((int(r.p), r.match_result, r.confidence_score) for b in rows for r in b.itertuples()), key=lambda r: r[0]):
        conf = 100 if conf is None or pd.isna(conf) else conf
        m = _NUMBER.match((match or "").strip())
        number = int(m[1]) if m else 0
        fits = m is not None and 1 <= number <= made and m[1] == f"{number:04d}" and conf >= split_below
        if not fits:
            made += 1
            number = made
        out.append((key[0], p, f"cluster_{number:04d}", not fits, bool(fits and conf < flag_below)))
    state.update((made,))
    yield pd.DataFrame(out, columns=["run_id", "p", "cluster_id", "is_new", "low_conf"])


def fold_stream(decisions: DataFrame, split_below: float = SPLIT_BELOW, flag_below: float = FLAG_BELOW) -> DataFrame:
    """The cluster fold over (run_id, p, match_result, confidence_score) as they
    arrive: the state of a run is one number. Decisions of a run must arrive in
    the order of ``p``, as the rounds that make them do."""

    def fold(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return _fold(key, rows, state, split_below, flag_below)

    return decisions.groupBy("run_id").applyInPandasWithState(fold, FOLD_OUT, "made int", "append", GroupStateTimeout.NoTimeout)
