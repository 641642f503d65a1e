"""Continuous periods and gaps of overlapping intervals, in two levels.

Intervals are clipped into time shards, merged inside each shard, and only what
touches a shard boundary is stitched across shards. An interval over many shards
gives three rows, however long it is: its pieces in the first and the last shard
and one cover row for the whole shards between. A key that holds a third of all
rows is therefore spread over as many groups as it has shards; the stitching
step sees one row for each shard of a key in which an interval starts or ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timecode import plain_ms, range_texts, readable_ms

SHARD_MS = 120_000


def _clipped(df: DataFrame, key: list[str], start: str, end: str, shard_ms: int) -> DataFrame:
    """(key..., shard, s, e, cover): pieces inside one shard, with ``cover``
    null, and covers, whose whole shards reach from ``shard`` up to ``cover``."""
    a, b = F.col(start).cast("bigint"), F.col(end).cast("bigint")
    iv = (
        df.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(*key, F.least(a, b).alias("s"), F.greatest(a, b).alias("e"))
        .groupBy(*key, "s")  # repeated rows and equal starts collapse before the shuffle
        .agg(F.max("e").alias("e"))
    )
    first, last = F.floor(F.col("s") / shard_ms).cast("bigint"), F.floor((F.col("e") - 1) / shard_ms).cast("bigint")
    iv = iv.withColumns({"f": first, "l": last})
    piece = lambda shard, s, e, cover: F.struct(shard.alias("shard"), s.alias("s"), e.alias("e"), cover.cast("bigint").alias("cover"))
    f, l, none = F.col("f"), F.col("l"), F.lit(None)  # noqa: E741
    head = piece(f, F.col("s"), F.least(F.col("e"), (f + 1) * shard_ms), none)
    tail = F.when(l > f, piece(l, l * shard_ms, F.col("e"), none))
    cover = F.when(l > f + 1, piece(f + 1, none.cast("bigint"), none.cast("bigint"), l))
    return iv.select(*key, F.explode(F.array(head, tail, cover)).alias("x")).where("x IS NOT NULL").select(*key, "x.shard", "x.s", "x.e", "x.cover")


def periods_and_gaps(df: DataFrame, key: list[str], start: str, end: str, shard_ms: int = SHARD_MS) -> DataFrame:
    """Rows (key..., kind, start_ms, end_ms) with kind ``period`` or ``gap``:
    the maximal continuous periods of each key and the gaps between neighbours.

    Rows with a null bound or equal bounds are no intervals; exchanged bounds
    are put in order; repeated rows change nothing; nothing is listed before the
    first period or after the last. An empty input gives no rows. Other columns
    are dropped, so none can clash.
    """
    pieces = _clipped(df, key, start, end, shard_ms)

    # Inside a shard: of the sorted pieces those that nothing before reaches begin a period.
    w = W.partitionBy(*key, "shard").orderBy("s", "e")  # covers, without s, come first
    reach = F.max("e").over(w.rowsBetween(W.unboundedPreceding, 0))
    local = pieces.withColumn("reach", reach).withColumn("done", F.lag("reach").over(w)).withColumn("last", F.lead("shard").over(w).isNull())
    begins = F.col("s").isNotNull() & (F.col("done").isNull() | (F.col("done") < F.col("s")))
    kept = local.where(begins | F.col("last") | F.col("cover").isNotNull()).withColumn("new", begins)
    # One row for each shard of a key: its merged pieces, at most one for every second millisecond, and how far covers reach.
    starts = F.array_sort(F.collect_list(F.when(F.col("new"), F.struct("s", "done"))))
    shards = kept.groupBy(*key, "shard").agg(starts.alias("starts"), F.max("reach").alias("reach"), F.max("cover").alias("cover"))
    merged = F.transform("starts", lambda x, i: F.struct(x["s"].alias("s"), F.coalesce(F.get(F.col("starts"), i + 1)["done"], F.col("reach")).alias("e")))

    # Over the shards of a key: a shard under a cover is one whole piece; what reaches a row's first piece joins it.
    v = W.partitionBy(*key).orderBy("shard")
    so_far = v.rowsBetween(W.unboundedPreceding, 0)
    lo, hi = F.col("shard") * shard_ms, (F.col("shard") + 1) * shard_ms
    covered = F.max("cover").over(so_far)
    rows = shards.select(*key, "shard", merged.alias("ps"), (covered * shard_ms).alias("under"))
    full = F.coalesce(F.col("under") >= hi, F.lit(False))
    rows = rows.withColumn("ps", F.when(full, F.array(F.struct(lo.alias("s"), hi.alias("e")))).otherwise(F.col("ps")))
    rows = rows.withColumns({"p1": F.get("ps", F.lit(0)), "n": F.size("ps"), "far": F.greatest(F.element_at("ps", -1)["e"], F.col("under"))})
    rows = rows.withColumn("far", F.max("far").over(so_far)).withColumn("before", F.lag("far").over(v))
    rows = rows.withColumn("joined", F.coalesce(F.col("before") >= F.col("p1.s"), F.lit(False)))
    # Only rows in which a period begins are kept, and a key's last; the next of them ends what is open.
    rows = rows.withColumn("final", F.lead("shard").over(v).isNull()).withColumn("opens", ~F.col("joined") | (F.col("n") > 1))
    rows = rows.where("opens OR final").withColumn("ends", F.when(F.col("joined"), F.col("p1.e")).otherwise(F.col("before")))
    follow = F.lead(F.struct("opens", "ends", "far")).over(v)
    rows = rows.withColumn("next", follow).where("opens")
    rows = rows.withColumn("close", F.when(F.col("next").isNull(), F.col("far")).when(F.col("next.opens"), F.col("next.ends")).otherwise(F.col("next.far")))

    item = lambda kind, s, e: F.struct(F.lit(kind).alias("kind"), s.alias("start_ms"), e.alias("end_ms"))
    begun = lambda i: ~F.col("joined") | (i > 0)

    def made(x: Column, i: Column) -> Column:
        e = F.when(i == F.col("n") - 1, F.col("close")).otherwise(x["e"])
        before = F.when(i == 0, F.col("before")).otherwise(F.get(F.col("ps"), i - 1)["e"])
        gap = F.when(begun(i) & before.isNotNull(), item("gap", before, x["s"]))
        return F.array(F.when(begun(i), item("period", x["s"], e)), gap)

    out = rows.select(*key, F.explode(F.flatten(F.transform("ps", made))).alias("r")).where("r IS NOT NULL")
    return out.select(*key, "r.kind", "r.start_ms", "r.end_ms")


def level_intervals(progress: DataFrame) -> DataFrame:
    """(run_id, level, a, b): the event and chunk intervals of the progress
    table, null where unreadable. Each text is read once."""
    read = progress.select("run_id", readable_ms(F.col("start_time")).alias("a"), readable_ms(F.col("end_time")).alias("b"), range_texts(F.col("chunk_time_range")).alias("both"))
    chunk = lambda i: plain_ms(F.get("both", F.lit(i)))
    rows = F.array(F.struct(F.lit("event").alias("level"), F.col("a"), F.col("b")), F.struct(F.lit("chunk").alias("level"), chunk(0).alias("a"), chunk(1).alias("b")))
    return read.select("run_id", F.explode(rows).alias("x")).select("run_id", "x.level", "x.a", "x.b")
