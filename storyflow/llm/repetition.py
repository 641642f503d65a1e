"""Repetition inside one text, with thresholds that adapt to language and source."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..common import cut
from .texts import SENTENCES, WORD, main_language

#: Words in the shortest phrase that counts wherever it stands again; of Han
#: characters, each a token of its own, one more.
PHRASE = 4
#: The share from which a text is a case, whatever the thresholds say.
CASE_SHARE = 0.3
#: No threshold falls below this share.
LOWEST = 0.1


def repeated_share(text: str | None, phrase: int = PHRASE) -> float:
    """The share of a text's letters in phrases that stood earlier in it.

    Phrases are runs of ``phrase`` words or more (one more for Han characters),
    whole sentences of two words or more however short, and words that follow
    themselves at once. Case, layout, punctuation and numbers do not count. A
    null, empty or letterless text has share 0; a text is always read whole.
    """
    if not text:
        return 0.0
    folded = text.casefold()
    words = [w for w in WORD.findall(folded) if not w.isdigit()]
    n = len(words)
    if n < 2:
        return 0.0
    doubled = any(map(str.__eq__, words, words[1:]))
    if not doubled and len(set(zip(words, words[1:]))) == n - 1:
        return 0.0  # no two words stand together twice, and none follows itself
    m = phrase + 1 if sum(1 for w in words if len(w) == 1 and w > "㏿") * 2 > n else phrase
    covered = bytearray(n)
    seen: set[tuple[str, ...]] = set()
    for i, g in enumerate(zip(*(words[i:] for i in range(m)))):
        if g in seen:
            covered[i : i + m] = b"\x01" * m
        else:
            seen.add(g)
    if doubled:
        for i in range(1, n):
            if words[i] == words[i - 1]:
                covered[i] = 1
    at, said = 0, set()
    for sentence in SENTENCES.split(folded):
        own = tuple(w for w in WORD.findall(sentence) if not w.isdigit()) if sentence else ()
        if 2 <= len(own) < m:
            if own in said:
                covered[at : at + len(own)] = b"\x01" * len(own)
            said.add(own)
        at += len(own)
    total = sum(map(len, words))
    return sum(len(w) for w, c in zip(words, covered) if c) / total


def text_values(progress: DataFrame, stage2: DataFrame, polished: DataFrame) -> DataFrame:
    """The three text fields as (field, run_id, item_id, source, text)."""
    a = progress.select(
        F.lit("step1_objective_visual").alias("field"), "run_id",
        F.concat_ws(":", F.col("chunk_i").cast("string"), F.col("ev_i").cast("string")).alias("item_id"),
        F.lit("pass1").alias("source"), F.col("step1_objective_visual").alias("text"),
    )
    b = stage2.select(F.lit("frame_caption").alias("field"), "run_id", F.col("event_id").alias("item_id"), "source", F.col("frame_caption").alias("text"))
    c = (
        polished.select("run_id", "source", F.explode("chapters.events").alias("es"))
        .select("run_id", "source", F.explode(F.arrays_zip(F.col("es.event_id").alias("i"), F.col("es.final_caption").alias("t"))).alias("e"))
        .select(F.lit("final_caption").alias("field"), "run_id", F.col("e.i").alias("item_id"), "source", F.col("e.t").alias("text"))
    )
    return a.unionByName(b).unionByName(c)


def shares(values: DataFrame, phrase: int = PHRASE) -> DataFrame:
    """(field, run_id, item_id, source, lang, share) of each value, a value
    delivered again counted once. Null texts give no row, blank ones share 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(4).to_pylist()
            lang = pa.array([main_language(t)[0] or None for t in texts], pa.string())
            share = pa.array([repeated_share(t, phrase) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], lang, share], names=["field", "run_id", "item_id", "source", "lang", "share"])

    rows = values.where(F.col("text").isNotNull()).select("field", "run_id", "item_id", "source", "text")
    made = rows.mapInArrow(run, "field string, run_id string, item_id string, source string, lang string, share double")
    return made.dropDuplicates(["field", "run_id", "item_id"])


def thresholds(measured: DataFrame, low: float = LOWEST, high: float = CASE_SHARE) -> DataFrame:
    """(field, lang, source, n, threshold): a far fence over the shares of each
    language and source, from mergeable quantile sketches.

    The fence is the upper quartile plus three times the distance of the
    quartiles, kept between ``low`` and ``high``: no group can raise its
    threshold above the share that makes a case.
    """
    sketch = measured.groupBy("field", "lang", "source").agg(F.kll_sketch_agg_double("share").alias("sketch"), F.count(F.lit(1)).alias("n"))
    q = lambda p: F.kll_sketch_get_quantile_double("sketch", F.lit(p))
    fence = q(0.75) + 3 * (q(0.75) - q(0.25))
    return sketch.select("field", "lang", "source", "n", F.least(F.lit(high), F.greatest(F.lit(low), fence)).alias("threshold"))


def repetitive(values: DataFrame, phrase: int = PHRASE) -> DataFrame:
    """(field, run_id, item_id, source, lang, share, threshold) of the texts at
    or above the threshold of their language and source."""
    measured = cut(shares(values, phrase))
    groups = thresholds(measured)
    groups = groups.select(F.col("field").alias("g1"), F.col("lang").alias("g2"), F.col("source").alias("g3"), "threshold")
    same = F.col("field").eqNullSafe(F.col("g1")) & F.col("lang").eqNullSafe(F.col("g2")) & F.col("source").eqNullSafe(F.col("g3"))
    # Shares below any possible threshold need not be joined.
    joined = measured.where(F.col("share") >= LOWEST).join(groups, same)
    return joined.where(F.col("share") >= F.col("threshold")).select("field", "run_id", "item_id", "source", "lang", "share", "threshold")
