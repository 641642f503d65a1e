"""Ordered texts: timelines, summaries, the story so far."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def flat(x: Column) -> Column:
    """Line breaks as blanks, outer blanks gone, null as ''."""
    return F.trim(F.replace(F.coalesce(x, F.lit("")), F.lit("\n"), F.lit(" ")))


def joined(df: DataFrame, keys: list[str], order: list[str], line: Column, between: str = "\n", name: str = "text") -> DataFrame:
    """(keys..., name): the lines of each key in order. The group is one text by
    its nature: one chunk, chapter list or cast."""
    g = df.select(*keys, F.struct(*order, line.alias("_line")).alias("_x")).groupBy(*keys).agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
    return g.select(*keys, F.array_join(F.transform("_xs", lambda x: x["_line"]), between).alias(name))


def story_so_far(df: DataFrame, key: str, order: str, summary: Column) -> DataFrame:
    """(key, order, kept, all_lines): the summaries before each piece, once the
    non-blank ones only and once every piece as a numbered line."""
    w = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    clean = F.trim(F.coalesce(summary, F.lit("")))
    x = df.select(key, order, F.nullif(clean, F.lit("")).alias("_s"), F.coalesce(summary, F.lit("")).alias("_raw"))
    lines = F.collect_list(F.concat(F.lit("Part "), (F.col(order) + 1).cast("string"), F.lit(": "), F.col("_raw"), F.lit("\n"))).over(w)
    return x.select(key, order, F.array_join(F.collect_list("_s").over(w), "\n").alias("kept"), F.array_join(lines, "").alias("all_lines"))
