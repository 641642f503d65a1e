"""Encoding with a public byte-level BPE and packing into fixed containers."""

from __future__ import annotations

import base64
import bisect
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..common import cut

#: Folder of the public vocabulary files; the session setting overrides it.
TOKENIZER_DIR = "/opt/tokenizers"
DIR_SETTING = "spark.storyflow.tokenizers.dir"

# Fixed value: the split pattern that belongs to this vocabulary.
SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Where a text may be cut without a change of its pieces: before a single blank
#: between two other characters, and between a letter or number and a mark.
_SAFE = r"(?<=\S)(?= \S)|(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}'])"
_CACHE: dict[str, object] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encoder(path: str):
    """The tiktoken encoding of a rank file, made once in each worker."""
    if path not in _CACHE:
        import tiktoken

        _CACHE[path] = tiktoken.Encoding(os.path.basename(path), pat_str=SPLIT_PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    return _CACHE[path]


def safe_parts(text: str, limit: int = 50_000) -> list[str]:
    """A long text in parts of about ``limit`` characters, cut only where the
    split pattern starts a new piece anyway; joined they are the text. A stretch
    without such a place stays whole."""
    if len(text) <= limit:
        return [text]
    import regex

    parts, start = [], 0
    safe = regex.compile(_SAFE)
    while len(text) - start > limit:
        m = safe.search(text, start + limit)
        if not m:
            break
        parts.append(text[start : m.start()])
        start = m.start()
    parts.append(text[start:])
    return parts


def encode(text: str | None, enc) -> list[int]:
    """Ids of a text; null and empty texts give an empty list. Lone surrogates
    cannot occur in a table's strings."""
    if not text:
        return []
    if len(text) <= 50_000:
        return enc.encode_ordinary(text)
    return [i for part in safe_parts(text) for i in enc.encode_ordinary(part)]


def decode(ids: list[int], enc) -> bytes:
    """The raw bytes of ids: exact for whole texts, and for any cut between ids."""
    return enc.decode_bytes(ids)


def vocabulary_path(spark: SparkSession, name: str = "byte_bpe_50k") -> str:
    return os.path.join(spark.conf.get(DIR_SETTING, None) or TOKENIZER_DIR, f"{name}.tiktoken")


def _per_text(df: DataFrame, path: str, schema: str, make: Callable[[list[int]], object], kind: pa.DataType, name: str, doc: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            made = pa.array([make(encode(t, enc)) for t in b.column(1).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([b.column(0), made], names=[doc, name])

    return df.select(doc, text).mapInArrow(run, schema)


def token_ids(df: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, ids) of every row; equal rows stay. No shuffle, no driver state."""
    return _per_text(df, path, f"{doc} {dict(df.dtypes)[doc]}, ids array<int>", lambda ids: ids, pa.list_(pa.int32()), "ids", doc, text)


def token_counts(df: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_tokens) of every row, 0 for null and empty texts."""
    return _per_text(df, path, f"{doc} {dict(df.dtypes)[doc]}, n_tokens int", len, pa.int32(), "n_tokens", doc, text)


class OpenWindows:
    """Bounded-space best fit: at most ``k`` open windows; an item goes where
    the least room remains, on a tie to the window opened first; if it fits
    nowhere and all are open, the fullest is emitted and a new one opened."""

    def __init__(self, capacity: int, k: int):
        self.capacity, self.k, self.made = capacity, k, 0
        self.room: list[tuple[int, int]] = []  # (room, window), ascending
        self.held: dict[int, list] = {}

    def place(self, size: int, item) -> list | None:
        """Place one item; the container that is emitted by it, if any."""
        i = bisect.bisect_left(self.room, (size, -1))
        if i < len(self.room):
            room, at = self.room.pop(i)
            self.held[at].append(item)
            if room == size:
                return self.held.pop(at)
            bisect.insort(self.room, (room - size, at))
            return None
        if size == self.capacity:
            return [item]
        out = self.held.pop(self.room.pop(0)[1]) if len(self.room) >= self.k else None
        bisect.insort(self.room, (self.capacity - size, self.made))
        self.held[self.made] = [item]
        self.made += 1
        return out

    def rest(self) -> list[list]:
        held, self.room, self.held = list(self.held.values()), [], {}
        return held


#: Rows that are sorted by size before they are placed.
_STRETCH = 1000
_PACKED = "doc_id {kind}, piece int, n_tokens int, container_id string, open boolean"


def _pack_batches(batches: Iterator[pa.RecordBatch], sizes: Callable, capacity: int, k: int, tag: str, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Place units of (size, [(doc, piece, tokens)...]) stretch by stretch."""
    from pyspark import TaskContext

    ctx = TaskContext.get()
    part, made = (ctx.partitionId() if ctx else 0), 0
    windows = OpenWindows(capacity, k)

    def rows(containers: list[list], still_open: bool) -> pa.RecordBatch:
        nonlocal made
        cols: list[list] = [[], [], [], [], []]
        for units in containers:
            cid = f"{tag}-{part}-{made}"
            made += 1
            for unit in units:
                for d, p, n in unit:
                    for c, v in zip(cols, (d, p, n, cid, still_open)):
                        c.append(v)
        kinds = (kind, pa.int32(), pa.int32(), pa.string(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "piece", "n_tokens", "container_id", "open"])

    for b in batches:
        # Large first inside a bounded stretch: as dense as sorting all, in bounded space.
        for at in range(0, b.num_rows, _STRETCH):
            units = sorted(sizes(b.slice(at, _STRETCH)), key=lambda x: -x[0])
            done = [full for size, unit in units if (full := windows.place(size, unit)) is not None]
            if done:
                yield rows(done, False)
    if left := windows.rest():
        yield rows(left, True)


def pack(df: DataFrame, path: str, capacity: int = 2048, open_windows: int = 512, merge_fan: int = 64, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, piece, n_tokens, container_id): every text that is not null or
    empty in a container of ``capacity`` tokens.

    Sizes and placing come from one pass over the scan's own partitions, so
    nothing is shuffled; each partition holds at most ``open_windows`` unfinished
    containers. A text above the capacity is cut into full containers and a
    remainder; any other stays whole as piece 0. The unfinished containers of
    ``merge_fan`` partitions at a time are then packed together the same way,
    whole containers as items, until one task holds all that is left. Ties go to
    the window opened first; repeated rows are placed each on its own; an empty
    table gives no rows.
    """

    def measured(b: pa.RecordBatch):
        enc = encoder(path)
        for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            n, p = len(encode(t, enc)), 0
            while n > 0:
                m = min(n, capacity)
                yield m, [(d, p, m)]
                n, p = n - m, p + 1

    source = df.where(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    of = source.schema["doc_id"].dataType
    schema, kind = _PACKED.format(kind=of.simpleString()), to_arrow_type(of)
    packed = cut(source.mapInArrow(lambda it: _pack_batches(it, measured, capacity, open_windows, "m0", kind), schema))
    final, left = packed.where(~F.col("open")), packed.where("open")

    def whole(b: pa.RecordBatch):
        for n, units in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            yield n, [(u["doc_id"], u["piece"], u["n_tokens"]) for u in units]

    parts, level = max(1, source.rdd.getNumPartitions()), 0
    while parts > 1:
        parts, level = -(-parts // merge_fan), level + 1
        units = (
            left.groupBy("container_id")  # at most `capacity` rows in a group
            .agg(F.sum("n_tokens").cast("int").alias("n"), F.array_sort(F.collect_list(F.struct("doc_id", "piece", "n_tokens"))).alias("units"))
            .repartition(parts, "container_id")
            .sortWithinPartitions(F.desc("n"), "container_id")
            .select("n", "units")
        )
        merged = cut(units.mapInArrow(lambda it, t=f"m{level}": _pack_batches(it, whole, capacity, open_windows, t, kind), schema))
        final, left = final.unionByName(merged.where(~F.col("open"))), merged.where("open")
    out = final.unionByName(left)
    return out.select(F.col("doc_id").alias(doc), "piece", "n_tokens", "container_id")
