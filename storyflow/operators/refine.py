"""Refinement and polish: start offsets, caption carry-over, progress, ladders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timecode import parse_seconds
from .pieces import neighbour


def adjusted_start(events: DataFrame, key: str, order: list[str], offset: float = 0.5) -> DataFrame:
    """Adds start_sec, end_sec and actual_start: an event that begins where the
    one before it in the whole video ended starts a little later, never past a
    hundredth before its own end. Events whose end is not after their start are
    left out after their neighbour has seen them."""
    e = events.withColumns({"start_sec": parse_seconds(F.col("start_time")), "end_sec": parse_seconds(F.col("end_time"))})
    e = neighbour(e, key, order, F.col("end_sec"), "_prev")
    meets = (F.abs(F.col("start_sec") - F.col("_prev")) < 0.01) & (F.col("start_sec") > 0)
    shifted = F.least(F.col("start_sec") + offset, F.greatest(F.col("start_sec"), F.col("end_sec") - 0.01))
    return e.withColumn("actual_start", F.when(meets, shifted).otherwise(F.col("start_sec"))).where("end_sec > start_sec").drop("_prev")


def previous_caption(events: DataFrame, keys: list[str], order: str, caption: str) -> DataFrame:
    """Adds ``previous``: the last non-empty caption before, within the chapter."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return events.withColumn("previous", F.coalesce(F.last(F.nullif(F.col(caption), F.lit("")), ignorenulls=True).over(w), F.lit("")))


def progress(events: DataFrame, keys: list[str], caption: str) -> DataFrame:
    """(keys..., total, done, remaining)."""
    done = F.count_if(F.coalesce(F.col(caption), F.lit("")) != "")
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), done.alias("done")).withColumn("remaining", F.col("total") - F.col("done"))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty; '' if none."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def polished_captions(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys..., caption): the last non-empty caption of each key."""
    kept = rows.where("coalesce(caption, '') <> ''")
    return kept.groupBy(*keys).agg(F.max_by("caption", F.struct(*order)).alias("polished"))
