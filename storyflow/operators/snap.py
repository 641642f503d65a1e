"""Event times against a chunk's whitelist of allowed times, relay decisions
and revisions of the event before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timecode import format_seconds, parse_seconds
from .pieces import neighbour


def whitelist(start: Column, times: Column) -> Column:
    """Sorted distinct ``[HH:MM:SS]`` texts of the times; the chunk's own start
    is put in front if it is not among them."""
    texts = F.array_sort(F.array_distinct(F.transform(times, format_seconds)))
    own = format_seconds(start)
    return F.when(F.array_contains(texts, own), texts).otherwise(F.array_prepend(texts, own))


def timed(texts: Column) -> Column:
    """Texts as a struct(sec, txt) array sorted by time; made once for a chunk,
    before its events are joined to it."""
    return F.array_sort(F.transform(texts, lambda t: F.named_struct(F.lit("sec"), parse_seconds(t), F.lit("txt"), t)))


def nearest(allowed: Column, target: Column) -> Column:
    """struct(d, sec, txt) of the allowed time nearest to ``target``; one within
    a hundredth first, ties to the earlier. Null for an empty array."""

    def ranked(w: Column) -> Column:
        d = F.abs(w["sec"] - target)
        return F.named_struct(F.lit("d"), F.when(d < 0.01, -1.0).otherwise(d), F.lit("sec"), w["sec"], F.lit("txt"), w["txt"])

    return F.array_min(F.transform(allowed, ranked))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once: a generated row is not inlined into
    the expressions that use it."""
    row = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_row")
    return df.select("*", row).select(*df.columns, *[F.col(f"_row.{n}").alias(n) for n in columns])


def snap_events(events: DataFrame) -> DataFrame:
    """Events with snapped ``start_time`` and ``end_time``.

    Needs start_time, end_time, chunk_start, chunk_end and ``allowed``, the
    sorted struct(sec, txt) array that ``timed`` makes of a chunk's texts.
    In this order: snap both ends to the nearest allowed time, exchange them if
    reversed, drop what is shorter than a tenth, then clamp an end more than
    half a second outside the chunk to the allowed time at that edge. With an
    empty whitelist nothing is changed; unreadable times read as 0.
    """
    e = _once(events, _t1=parse_seconds(F.col("start_time")), _t2=parse_seconds(F.col("end_time")))
    low, high = F.col("chunk_start") - 0.1, F.col("chunk_end") + 0.1
    e = _once(
        e,
        _a=nearest(F.col("allowed"), F.col("_t1")),
        _b=nearest(F.col("allowed"), F.col("_t2")),
        _lo=F.array_min(F.filter("allowed", lambda w: w["sec"] >= low))["txt"],
        _hi=F.array_max(F.filter("allowed", lambda w: w["sec"] <= high))["txt"],
    )
    turned = F.col("_a.sec") > F.col("_b.sec")
    e = _once(e, _s=F.when(turned, F.col("_b")).otherwise(F.col("_a")), _e=F.when(turned, F.col("_a")).otherwise(F.col("_b")))
    none = F.size("allowed") == 0
    e = e.where(none | (F.col("_e.sec") - F.col("_s.sec") >= 0.1))
    s = F.when(F.col("_s.sec") < F.col("chunk_start") - 0.5, F.coalesce("_lo", "_s.txt")).otherwise(F.col("_s.txt"))
    t = F.when(F.col("_e.sec") > F.col("chunk_end") + 0.5, F.coalesce("_hi", "_e.txt")).otherwise(F.col("_e.txt"))
    out = {"start_time": F.when(none, F.col("start_time")).otherwise(s), "end_time": F.when(none, F.col("end_time")).otherwise(t)}
    return e.withColumns(out).select(*events.columns)


def outside_key_frames(frames: Column, start: Column, end: Column) -> Column:
    """Key frame times more than a tenth outside (start, end); only reported."""
    s, e = parse_seconds(start), parse_seconds(end)
    return F.filter(
        F.coalesce(frames, F.array().cast("array<string>")),
        lambda k: k.isNotNull() & ((parse_seconds(k) < s - 0.1) | (parse_seconds(k) > e + 0.1)),
    )


def next_start(chunk_start: Column, chunk_end: Column, last_end: Column, anchor: Column | None = None, length: float = 60.0) -> Column:
    """Where the next chunk begins: the last event's end if it lies between five
    seconds after the chunk's start and ten after its end, else four fifths of
    the configured length on. With an overlap anchor more than a second after
    the start, the anchor."""
    good = (last_end >= chunk_start + 5) & (last_end <= chunk_end + 10)
    live = last_end if anchor is None else F.when(anchor > chunk_start + 1.0, anchor).otherwise(last_end)
    return F.when(good, live).otherwise(chunk_start + 0.8 * length)


def tail(events: DataFrame, keys: list[str], order: str, k: int) -> DataFrame:
    """The last ``k`` events of each key."""
    return events.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))).where(F.col("_n") <= k).drop("_n")


#: What a revision may replace of an event; its start stays.
REVISED = ("end_time", "step1_objective_visual", "step2_contextual_reasoning", "step3_synthesized_dense_caption", "key_frame_times")


def apply_revisions(events: DataFrame, revisions: DataFrame, run: str = "run_id") -> DataFrame:
    """Events after the revisions that later chunks bring for the last event of
    the chunk before.

    ``revisions`` holds (run, chunk_i, need_merge, start_time) and any of
    ``REVISED``, one row for each chunk at most. One counts if it asks to merge
    and its start agrees within a hundredth; it replaces only the fields it
    provides, of those the events have. Other columns are left out.
    """
    last = events.groupBy(run, "chunk_i").agg(F.max("ev_i").alias("ev_i"))
    before = last.withColumn("_chunk", F.lead("chunk_i").over(W.partitionBy(run).orderBy("chunk_i")))
    fields = [c for c in REVISED if c in events.columns and c in revisions.columns]
    r = revisions.select(F.col(run), F.col("chunk_i").alias("_chunk"), "need_merge", F.col("start_time").alias("_rs"), *[F.col(c).alias(f"_new_{c}") for c in fields])
    target = before.join(r.where("need_merge"), [run, "_chunk"]).drop("_chunk", "need_merge")
    joined = events.join(target, [run, "chunk_i", "ev_i"], "left")
    hit = F.col("_rs").isNotNull() & (F.abs(parse_seconds(F.col("start_time")) - parse_seconds(F.col("_rs"))) <= 0.01)
    changed = {c: F.when(hit, F.coalesce(f"_new_{c}", c)).otherwise(F.col(c)) for c in fields}
    return joined.withColumns({"revised": F.coalesce(hit, F.lit(False))} | changed).drop("_rs", *[f"_new_{c}" for c in fields])


def timeline_gaps(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Neighbouring events whose times do not meet: (key, order..., end_sec,
    next_start_sec, gap_sec); negative gaps are overlaps."""
    e = events.select(key, *order, parse_seconds(F.col("end_time")).alias("end_sec"), parse_seconds(F.col("start_time")).alias("_s"))
    e = neighbour(e, key, order, F.col("_s"), "next_start_sec", ahead=True).drop("_s")
    return e.withColumn("gap_sec", F.col("next_start_sec") - F.col("end_sec")).where(F.abs("gap_sec") >= 0.01)
