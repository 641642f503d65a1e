"""Mounting events into chapters and the texts around chapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timecode import parse_seconds
from ..functions import text as X

#: A chapter takes events from so many seconds before its start; the last one to so many after its end.
EARLY, TAIL = 0.5, 9999.0


def _with_bounds(chapters: DataFrame, key: str) -> DataFrame:
    last = F.max("ch_idx").over(W.partitionBy(key))
    c = chapters.withColumns({"_s": parse_seconds(F.col("start_time")), "_raw_end": parse_seconds(F.col("end_time")), "_last": F.col("ch_idx") == last})
    return c.withColumn("_e", F.when(F.col("_last"), F.col("_raw_end") + TAIL).otherwise(F.col("_raw_end")))


def _bucket(t: Column, width: float, even: int = 1008) -> Column:
    """The time bucket of ``t`` seconds: ``even`` buckets of ``width``, beyond
    them 64 for every doubling. Never falls as ``t`` grows, below zero too."""
    edge = width * even
    far = even + F.floor(F.log2(F.abs(t) / edge) * 64)
    return F.when(t.between(-edge, edge), F.floor(t / width)).when(t < 0, -far - 1).otherwise(far).cast("bigint")


def mount(events: DataFrame, chapters: DataFrame, key: str = "run_id", bucket: float = 600.0, once: bool = False) -> DataFrame:
    """(key, ch_idx, event_id, chunk_i, ev_i): which events belong to which
    chapter, numbered in the order of the events.

    An event belongs to a chapter if it starts from half a second before the
    chapter's start up to its end; to two that touch, unless ``once``, then to
    the earlier. Both sides are joined on the key and a time bucket, each
    chapter standing in every bucket it reaches, so a long video's events never
    meet all of its chapters in one task. Times are read leniently and may be
    anything, so buckets grow wider beyond a week, and no chapter stands in more
    than a few thousand of them. ``events`` has start_time, chunk_i and
    ev_i; unreadable times read as 0; events outside every chapter fall away.
    """
    c = _with_bounds(chapters.select(key, "ch_idx", "start_time", "end_time"), key).where(F.col("_s") - EARLY < F.col("_e"))
    at = lambda x: _bucket(x, bucket)
    spread = c.select(key, "ch_idx", "_s", "_e", F.explode(F.sequence(at(F.col("_s") - EARLY), at(F.col("_e")))).alias("_b"))
    e = events.select(key, "chunk_i", "ev_i", parse_seconds(F.col("start_time")).alias("_t")).withColumn("_b", at(F.col("_t")))
    met = e.join(spread, [key, "_b"]).where((F.col("_t") >= F.col("_s") - EARLY) & (F.col("_t") < F.col("_e")))
    if once:
        met = met.groupBy(key, "chunk_i", "ev_i").agg(F.min("ch_idx").alias("ch_idx"))
    n = F.row_number().over(W.partitionBy(key, "ch_idx").orderBy("chunk_i", "ev_i"))
    return met.select(key, "ch_idx", "chunk_i", "ev_i", F.format_string("ev_%02d_%03d", F.col("ch_idx") + 1, n).alias("event_id"))


def overflow(events: DataFrame, chapters: DataFrame, mounted: DataFrame, key: str = "run_id", lost_only: bool = False) -> DataFrame:
    """(key, ch_idx, event_id, chunk_i, ev_i): events appended to the last chapter.

    Where fewer events are mounted than there are, all that start at or after
    the last chapter's own end are appended, counting on from its events. With
    ``lost_only`` those that belong to no chapter at all are appended instead.
    """
    last = _with_bounds(chapters.select(key, "ch_idx", "start_time", "end_time"), key).where("_last").select(key, "ch_idx", "_raw_end")
    e = events.select(key, "chunk_i", "ev_i", parse_seconds(F.col("start_time")).alias("_t"))
    have = mounted.groupBy(key).agg(F.count(F.lit(1)).alias("_have"))
    in_last = mounted.join(last, [key, "ch_idx"]).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = e.groupBy(key).agg(F.count(F.lit(1)).alias("_total"))
    if lost_only:
        more = e.join(mounted.select(key, "chunk_i", "ev_i").distinct(), [key, "chunk_i", "ev_i"], "left_anti").join(last, key)
    else:
        short = total.join(have, key, "left").where(F.coalesce("_have", F.lit(0)) < F.col("_total")).select(key)
        more = e.join(last.join(short, key), key).where("_t >= _raw_end")
    n = F.row_number().over(W.partitionBy(key).orderBy("chunk_i", "ev_i"))
    more = more.join(in_last, key, "left")
    return more.select(key, "ch_idx", "chunk_i", "ev_i", F.format_string("ev_fallback_%03d", F.coalesce("_n", F.lit(0)) + n).alias("event_id"))


def single_chapter(events: DataFrame, chapters: DataFrame, key: str = "run_id") -> DataFrame:
    """One chapter over all events for each key that has events and no chapter."""
    lone = events.join(chapters.select(key).distinct(), key, "left_anti")
    order = F.struct("chunk_i", "ev_i")
    g = lone.groupBy(key).agg(F.min_by(F.struct("start_time"), order).alias("a"), F.max_by(F.struct("end_time"), order).alias("b"))
    return g.select(key, F.lit(0).alias("ch_idx"), F.lit("ch_01").alias("chapter_id"), F.col("a.start_time").alias("start_time"), F.col("b.end_time").alias("end_time"))


def last_described(sightings: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, name, descr): the description a name was given last."""
    named = sightings.where("temp_name is not null")
    g = named.groupBy(key, F.col("temp_name").alias("name")).agg(F.max_by(F.struct("descr"), F.struct(*order)).alias("d"))
    return g.select(key, "name", F.col("d.descr").alias("descr"))


def event_characters(texts: DataFrame, bank: DataFrame, key: str, item: str, text: str) -> DataFrame:
    """(key, item, ord, name, descr): the ``[...]`` mentions of each text in the
    order they first stand there, with their descriptions, '' if unknown."""
    m = texts.select(key, item, F.posexplode(X.mentions(F.col(text))).alias("ord", "name"))
    return m.join(bank, [key, "name"], "left").select(key, item, "ord", "name", F.coalesce("descr", F.lit("")).alias("descr"))
