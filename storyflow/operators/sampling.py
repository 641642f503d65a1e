"""Which moments of a video to look at: chunk plans, scene clipping, frame
budgets and frame times. All of it is arithmetic on Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def chunk_plan(videos: DataFrame, total: Column, keys: list[str], length: float = 60.0) -> DataFrame:
    """(keys..., chunk_i, chunk_start, chunk_end): tumbling chunks up to the
    whole seconds of the duration; the last one is shorter. A null duration or
    one below a second gives no chunk."""
    t = F.floor(total).cast("double")
    n = F.ceil(t / length).cast("int")
    return (
        videos.where(t >= 1)
        .select(*keys, t.alias("_t"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_i"))
        .select(*keys, "chunk_i", (F.col("chunk_i") * length).alias("chunk_start"), F.least((F.col("chunk_i") + 1) * length, F.col("_t")).alias("chunk_end"))
    )


def clip_scenes(scenes: DataFrame, chunks: DataFrame, key: str, length: float = 60.0) -> DataFrame:
    """(key, chunk_i, chunk_start, chunk_end, scene_idx, s, e): scenes clipped to
    chunks; a chunk without any becomes one scene over all of it, index 0.

    A scene is exploded to the chunks it can touch, of those its video has, and
    joined by chunk number, so no chunk meets all scenes of its video. ``scenes``
    has (key, scene_idx, start_sec, end_sec); empty and reversed scenes fall away.
    """
    top = chunks.groupBy(key).agg(F.max("chunk_i").alias("_top"))
    first, last = F.floor(F.col("start_sec") / length), F.least(F.floor(F.col("end_sec") / length), F.col("_top"))
    inside = scenes.where("start_sec < end_sec and end_sec > 0").join(top, key).withColumns({"_first": F.least(F.greatest(first, F.lit(0)), F.col("_top") + 1).cast("int"), "_last": last.cast("int")})
    spread = inside.where("_first <= _last").withColumn("chunk_i", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last", "_top")
    met = chunks.join(spread, [key, "chunk_i"], "left")
    s, e = F.greatest("start_sec", "chunk_start"), F.least("end_sec", "chunk_end")
    clipped = met.withColumns({"s": s, "e": e}).withColumn("_in", F.coalesce(F.col("s") < F.col("e"), F.lit(False)))
    any_in = F.max("_in").over(W.partitionBy(key, "chunk_i"))
    n = F.row_number().over(W.partitionBy(key, "chunk_i").orderBy(F.col("_in").desc(), "scene_idx"))
    kept = clipped.withColumns({"_any": any_in, "_n": n}).where(F.col("_in") | (~F.col("_any") & (F.col("_n") == 1)))
    pick = lambda a, b: F.when(F.col("_any"), F.col(a)).otherwise(F.col(b))
    return kept.select(key, "chunk_i", "chunk_start", "chunk_end", (F.col("_n") - 1).alias("scene_idx"), pick("s", "chunk_start").alias("s"), pick("e", "chunk_end").alias("e"))


def frame_budget(scenes: DataFrame, keys: list[str], frames: int = 240) -> DataFrame:
    """Adds ``alloc``: the frames of each scene, proportional to its length, at
    least one while any are left, the rest to the last scene.

    Closed form of the running budget: with want_i = max(1, round(share * M)) and
    C_i = min(M, want_1 + ... + want_i), alloc_i = C_i - C_(i-1), and M - C_(n-1)
    for the last. Rounding is half to even.
    """
    w = W.partitionBy(*keys).orderBy("scene_idx")
    whole = W.partitionBy(*keys)
    d = F.col("e") - F.col("s")
    total = F.sum(d).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    total = F.when(total == 0, 1e-5).otherwise(total)
    want = F.greatest(F.lit(1), F.bround(d / total * frames, 0).cast("int"))
    base = scenes.withColumn("_want", want)
    upto = F.least(F.lit(frames), F.sum("_want").over(w.rowsBetween(W.unboundedPreceding, 0)))
    before = F.least(F.lit(frames), F.coalesce(F.sum("_want").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    is_last = F.col("scene_idx") == F.max("scene_idx").over(whole)
    return base.withColumn("alloc", F.when(is_last, F.lit(frames) - before).otherwise(upto - before).cast("int")).drop("_want")


def inner_points(s: Column, e: Column, n: Column) -> Column:
    """``n`` evenly spaced times strictly inside (s, e); the middle for one, an
    empty array for none."""
    some = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: s + (e - s) * k / (n + 1))
    return F.when(n > 0, some).otherwise(F.array().cast("array<double>"))


def frame_times(budget: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., ts): the distinct frame times of all scenes of a chunk."""
    return budget.select(*keys, F.explode(inner_points(F.col("s"), F.col("e"), F.col("alloc"))).alias("ts")).distinct()


def uniform_times(s: Column, e: Column, n: int) -> Column:
    """``n`` times from ``s`` to ``e`` including both ends."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: s + (e - s) * k / (n - 1)) if n > 1 else F.array(s)


def event_frame_count(s: Column, e: Column, fps: float, most: int) -> Column:
    """How many frames an event of (s, e) gets at ``fps``; null unless e > s."""
    by_rate = F.greatest(F.lit(1), F.bround((e - s) * max(fps, 1e-6), 0).cast("int"))
    return F.when(e > s, F.least(by_rate, F.lit(max(1, most))))


def frame_index(ts: Column, fps: Column) -> Column:
    """The frame number of a time: truncated, never rounded."""
    return (ts * fps).cast("bigint")


def clip_frames(start: Column, end: Column, fps: Column, target_fps: float) -> Column:
    """Frame numbers of a clip: every max(1, round(fps / target))-th frame of
    the inclusive range."""
    step = F.greatest(F.lit(1), F.bround(fps / target_fps, 0).cast("bigint"))
    return F.sequence((start * fps).cast("bigint"), (end * fps).cast("bigint"), step)


def shrink(width: Column, height: Column, most: int) -> tuple[Column, Column]:
    """Width and height after a resize that only ever shrinks; truncated."""
    scale = F.least(F.lit(1.0), F.lit(float(most)) / width)
    fits = width <= most
    return F.when(fits, width).otherwise((width * scale).cast("int")), F.when(fits, height).otherwise((height * scale).cast("int"))


def even_sample(n: Column, k: int) -> Column:
    """Positions of ``k`` of ``n`` items including both ends; all if n <= k."""
    everything = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    if k == 1:
        some = F.array(F.lit(0))
    elif k == 2:
        some = F.array(F.lit(0), n - 1)
    else:
        inner = F.transform(F.sequence(F.lit(1), F.lit(k - 2)), lambda j: F.bround(j * (n - 1) / (k - 1), 0).cast("int"))
        some = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0)), inner, F.array(n - 1))))
    return F.when(n <= 0, F.array().cast("array<int>")).when(n <= k, everything).otherwise(some)
