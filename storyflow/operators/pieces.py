"""Neighbours and numbers along a long order, without one task for a whole key.

The first column of the order (a chunk, a chapter) cuts a key into pieces. Rows
look at their neighbours inside a piece; only one row for each piece passes
through a window over the whole key. A key with a third of all rows is spread
over as many groups as it has pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _with_summary(df: DataFrame, key: str, piece: str, summary: DataFrame) -> DataFrame:
    s = summary.withColumnsRenamed({key: "_key", piece: "_piece"})
    return df.join(s, F.col(key).eqNullSafe(F.col("_key")) & F.col(piece).eqNullSafe(F.col("_piece")), "left").drop("_key", "_piece")


def neighbour(df: DataFrame, key: str, order: list[str], value: Column, name: str, ahead: bool = False) -> DataFrame:
    """Adds ``name``: ``value`` of the row before, or after with ``ahead``, in
    the order of a key; null for the first or last row. The order must name a
    row; rows equal in it are neighbours in any order."""
    piece, rest = order[0], order[1:]
    x = df.withColumn("_v", value)
    w = W.partitionBy(key, piece).orderBy(*rest)
    step = F.lead if ahead else F.lag
    x = x.withColumns({"_near": step("_v").over(w), "_edge": step(F.lit(1)).over(w).isNull()})
    pick = F.min_by if ahead else F.max_by
    ends = df.withColumn("_v", value).groupBy(key, piece).agg(pick("_v", F.struct(*rest)).alias("_end"))
    ends = ends.select(key, piece, step("_end").over(W.partitionBy(key).orderBy(piece)).alias("_beside"))
    out = _with_summary(x, key, piece, ends)
    return out.withColumn(name, F.when(F.col("_edge"), F.col("_beside")).otherwise(F.col("_near"))).drop("_v", "_near", "_edge", "_beside")


def numbered(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Adds ``name``: the number of a row in the order of its key, from 1."""
    piece, rest = order[0], order[1:]
    x = df.withColumn("_own", F.row_number().over(W.partitionBy(key, piece).orderBy(*rest)))
    sizes = df.groupBy(key, piece).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(W.partitionBy(key).orderBy(piece).rowsBetween(W.unboundedPreceding, -1))
    out = _with_summary(x, key, piece, sizes.select(key, piece, F.coalesce(before, F.lit(0)).alias("_before")))
    return out.withColumn(name, (F.col("_own") + F.col("_before")).cast("int")).drop("_own", "_before")
