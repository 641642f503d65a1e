"""Runs of consecutive events that tell the same thing, as one event each."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..common import cut
from ..functions.timecode import readable_ms

# Words that only link a sentence to what came before, and
# remarks that only say that something goes on.
LINKING = (
    "and then", "then", "again", "still", "once more", "once again", "next", "afterwards", "after that", "and", "now",
    "dann", "wieder", "weiterhin", "noch einmal", "erneut", "danach", "und dann", "nun",
    "luego", "otra vez", "de nuevo", "aún así", "aun así", "entonces", "después", "nuevamente", "todavía", "y luego",
    "puis", "encore", "de nouveau", "ensuite", "toujours", "затем", "снова", "опять", "потом",
    "随后", "仍然", "再次", "接着", "然后", "再一次", "依然", "继续",
)
GOES_ON = (
    "and so it goes on", "and so on", "continued", "cont", "contd", "to be continued", "continues", "still going on",
    "und so geht es weiter", "und so weiter", "weiter", "fortsetzung", "geht weiter",
    "y así continúa", "y así sigue", "continúa", "continuación", "sigue",
    "et ainsi de suite", "suite", "à suivre", "продолжение", "и так далее",
    "续", "接上", "动作仍在继续", "仍在继续", "未完待续",
)

_HAN = r"[㐀-鿿]"


def _alternatives(words: tuple[str, ...], backwards: bool = False) -> str:
    return "|".join(w[::-1] if backwards else w for w in sorted(words, key=len, reverse=True))


def _count(word: Column, letter: Column) -> Column:
    return F.length(word) - F.length(F.replace(word, letter, F.lit("")))


def _slip(x: Column, y: Column) -> Column:
    """True if two words differ in neighbouring letters exchanged or letters
    doubled only, on either side: every letter stands equally often in both, or
    more often where it stands doubled, or doubled and then exchanged; the first
    letter stays or is exchanged with the second."""
    at = lambda w, i: F.substring(w, i, 1)
    start = (at(x, 1) == at(y, 1)) | ((at(x, 1) == at(y, 2)) & (at(x, 2) == at(y, 1)))
    apart = (F.greatest(F.length(x), F.length(y)) >= 6) & (F.abs(F.length(x) - F.length(y)) <= 1)
    doubled = lambda w, c: F.contains(w, F.concat(c, c)) | (apart & F.regexp_like(w, F.concat(c, F.lit("."), c)))

    def fits(c: Column) -> Column:
        cx, cy = _count(x, c), _count(y, c)
        return (cx == cy) | ((cx > cy) & (cy > 0) & doubled(x, c)) | ((cy > cx) & (cx > 0) & doubled(y, c))

    letters = F.array_distinct(F.split(F.concat(x, y), ""))
    return start & (F.levenshtein(x, y, 6) >= 0) & F.forall(letters, fits)


#: Linking phrases long enough to be known by their letters when misspelt.
_LONG_LINKS = tuple(p for p in LINKING if len(p.replace(" ", "")) >= 7 and p.isascii())


def _without_misspelt_link(k: Column) -> Column:
    """A key without a linking phrase at its start that holds a slip of the pen."""
    out = k
    for n in sorted({p.count(" ") + 1 for p in _LONG_LINKS}):
        links = [p for p in _LONG_LINKS if p.count(" ") + 1 == n]
        head = F.substring_index(k, " ", n)
        marks = F.concat_ws("", F.array_sort(F.split(F.regexp_replace(head, r"(.)\1+", "$1"), "")))
        known = sorted({"".join(sorted(re.sub(r"(.)\1+", r"\1", p))) for p in links})
        begins = F.substring(k, 1, 1).isin(sorted({c for p in links for c in p[:2]}))
        size = F.length(head)
        fits = begins & (size >= min(map(len, links)) - 1) & (size <= max(map(len, links)) + 2) & (size < F.length(k))
        out = F.when(fits & marks.isin(known), F.substring(k, size + 2, F.lit(1 << 30))).otherwise(out)
    return out


def with_caption_key(df: DataFrame, caption: str, name: str) -> DataFrame:
    """``df`` with the key of a caption as ``name`` instead of the caption: the
    text without what belongs to its surface: case, layout, brackets,
    punctuation, the Chinese particle 的, linking words at the start and remarks
    that it goes on at the end. Null for a null or blank caption. A caption of
    nothing but punctuation is its own key.

    Each step is a column of its own, so that no text is rewritten twice.
    """
    k, c = F.col(name), F.col(caption)
    out = df.withColumn(name, F.regexp_replace(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), r"[^\p{L}\p{N}]+", " "))
    han = F.regexp_replace(k, f"(?<={_HAN}) (?={_HAN})|的", "")
    han = F.regexp_replace(han, f"(?<={_HAN})(?=[^㐀-鿿 ])|(?<=[^㐀-鿿 ])(?={_HAN})", " ")
    out = out.withColumn(name, F.trim(F.when(k.rlike(_HAN), han).otherwise(k)))
    blank = c.isNull() | ((k == "") & c.rlike(r"^[\s\p{Z}\p{C}]*$"))
    out = out.withColumn(name, F.when(~blank, F.when(k == "", F.trim(c)).otherwise(k))).drop(caption)
    out = out.withColumn("_bare", F.regexp_replace(k, f"^(?:(?:{_alternatives(LINKING)})(?: |$|(?<={_HAN})))+", ""))
    out = out.withColumn("_bare", _without_misspelt_link(F.col("_bare")))
    # Read from the end, so that the pattern is tried at one place only.
    bare = F.reverse(F.regexp_replace(F.reverse("_bare"), f"^(?:(?:{_alternatives(GOES_ON, True)})(?: |$|(?={_HAN})))+", ""))
    out = out.withColumn("_bare", F.trim(bare))
    return out.withColumn(name, F.when(F.col("_bare") == "", k).otherwise(F.col("_bare"))).drop("_bare")


def same_telling(a: Column, b: Column) -> Column:
    """True if two keys differ in nothing or in slips of the pen only: word by
    word the same, but for neighbouring letters exchanged or letters doubled, on
    either side. Another word, name or number is a difference, and so is a letter
    that is missing or another one: those make other words ("bowl", "bow"). Null
    if either is null.
    """
    wa, wb = F.split(a, " "), F.split(b, " ")
    words = F.zip_with(wa, wb, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    near = (F.size(wa) == F.size(wb)) & F.forall(words, lambda p: (p["x"] == p["y"]) | _slip(p["x"], p["y"]))
    return (a == b) | near


def collapse_runs(progress: DataFrame, piece_ms: int = 60_000) -> DataFrame:
    """(run_id, chunk_i, ev_i, n_events, duration_ms) of each longest stretch of
    two or more successive events of a run that tell the same thing.

    Order is by the time ``start_time`` names, not exchanged with an earlier
    end, then chunk_i and ev_i. Only boundary rows are kept, those that differ
    from their predecessor, and the last of a piece; lead over them gives the
    position of the next boundary, and so the count, and the latest time reached
    just before it, and so the duration. The time reached is a running maximum
    over (position of the last boundary, latest readable start or end), which
    starts anew at every boundary.

    Minutes of the start cut a run into pieces that keep the order, so a run
    with a third of all rows is spread over many groups; what touches the edge
    of a piece is stitched over at most two rows for each minute of a run. Rows
    delivered again count once; null and blank captions belong to no stretch and
    end one; rows without a readable start are left out; an empty table gives no
    rows. Other columns are dropped at once and cannot clash.
    """
    start, end = readable_ms(F.col("start_time")), readable_ms(F.col("end_time"))
    e = progress.select(
        "run_id", "chunk_i", "ev_i", start.alias("at"), F.greatest(start, end).alias("late"),
        F.col("step3_synthesized_dense_caption").alias("caption"),
    ).where(F.col("at").isNotNull())
    e = with_caption_key(e, "caption", "k")
    e = e.withColumn("piece", F.floor(F.col("at") / piece_ms))
    w = W.partitionBy("run_id", "piece").orderBy("at", "chunk_i", "ev_i", "k", "late")
    running = w.rowsBetween(W.unboundedPreceding, 0)
    again = F.row_number().over(w) > 1
    for c in ("at", "chunk_i", "ev_i", "k", "late"):
        again = again & F.lag(c).over(w).eqNullSafe(F.col(c))
    e = e.withColumn("_again", again).where(~F.col("_again")).drop("_again")
    e = e.withColumns({"before": F.lag("k").over(w), "pos": F.row_number().over(w), "last": F.lead("at").over(w).isNull()})
    e = e.withColumn("new", (F.col("pos") == 1) | ~F.coalesce(same_telling(F.col("k"), F.col("before")), F.lit(False)))
    e = e.withColumn("since", F.max(F.when(F.col("new"), F.col("pos"))).over(running))
    e = e.withColumn("reach", F.max(F.struct("since", "late")).over(running)["late"])
    e = e.withColumn("done", F.lag("reach").over(w)).where("new OR last")
    follow = F.lead(F.struct("new", "pos", "done", "reach", "before", "k")).over(w)
    inside = ~F.col("next.new")  # the piece's last row, in the stretch of this boundary
    b = e.withColumn("next", follow).where("new").select(
        "run_id", "piece", "pos", F.struct("at", "chunk_i", "ev_i").alias("head"), F.col("k").alias("k1"),
        F.when(F.col("next").isNull(), F.col("k")).when(inside, F.col("next.k")).otherwise(F.col("next.before")).alias("k2"),
        F.coalesce(F.col("next.pos") + inside.cast("int") - F.col("pos"), F.lit(1)).cast("bigint").alias("n"),
        F.when(F.col("next").isNull(), F.col("late")).when(inside, F.col("next.reach")).otherwise(F.col("next.done")).alias("late"),
        ((F.col("pos") == 1) | F.col("next").isNull() | inside).alias("edge"),
    )
    b = b.where(F.col("edge") | ((F.col("n") > 1) & F.col("k1").isNotNull()))
    b = cut(b.withColumns({"k1": F.when(F.col("edge"), F.col("k1")), "k2": F.when(F.col("edge"), F.col("k2"))}))
    inner = b.where(~F.col("edge")).select("run_id", "head", "n", "late")
    order = W.partitionBy("run_id").orderBy("piece", "pos")
    joined = (F.col("pos") == 1) & F.coalesce(same_telling(F.col("k1"), F.lag("k2").over(order)), F.lit(False))
    edges = b.where("edge").withColumn("_joined", joined)
    edges = edges.withColumn("isl", F.sum((~F.col("_joined")).cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    whole = edges.groupBy("run_id", "isl").agg(F.min("head").alias("head"), F.sum("n").alias("n"), F.max("late").alias("late"), F.max("k1").alias("k"))
    whole = whole.where(F.col("k").isNotNull() & (F.col("n") > 1)).select("run_id", "head", "n", "late")
    return inner.unionByName(whole).select(
        "run_id", F.col("head.chunk_i").alias("chunk_i"), F.col("head.ev_i").alias("ev_i"), F.col("n").cast("int").alias("n_events"),
        (F.col("late") - F.col("head.at")).alias("duration_ms"),
    )
