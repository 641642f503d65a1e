"""Nested storyboards as flat child tables with parent positions.

Typed columns are unnested with ``posexplode``. JSON text is read by a
structural index over its bytes: bitmaps of quotes, brackets and delimiters,
nesting depth by prefix sums, spans between structural bytes, and linked rows
from those spans; the text is never turned into a tree of objects.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHILD_SCHEMA = "tbl string, level string, run_id string, chapter_pos int, event_pos int, item_pos int, child_key string"
_WS = b" \t\r\n"
_SCALAR = re.compile(rb"(?:true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)\Z")
_STRING = re.compile(rb'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"\Z')


class StructuralIndex:
    """Structural bytes of one JSON text with their depth and partner.

    ``ok`` is false unless the text is one whole JSON value (a leading byte
    order mark and outer blanks aside).
    """

    def __init__(self, text: bytes):
        self.text = text
        raw = np.frombuffer(text, dtype=np.uint8)
        # Escapes: a quote counts if an even number of backslashes stands before it.
        slash = raw == 0x5C
        quote = raw == 0x22
        if slash.any():
            at = np.arange(raw.size)
            last_plain = np.maximum.accumulate(np.where(slash, -1, at))
            before = np.empty(raw.size, dtype=np.int64)
            before[0] = 0
            before[1:] = at[1:] - 1 - last_plain[:-1]
            quote &= before % 2 == 0
        inside = (np.cumsum(quote) & 1).astype(bool)  # true from an opening quote up to before its closing one
        outside = ~inside & ~quote
        opens = outside & ((raw == 0x7B) | (raw == 0x5B))
        closes = outside & ((raw == 0x7D) | (raw == 0x5D))
        marks = opens | closes | (outside & ((raw == 0x2C) | (raw == 0x3A)))
        self.pos = np.flatnonzero(marks)
        self.kind = raw[self.pos]
        step = np.where(opens[self.pos], 1, 0) - np.where(closes[self.pos], 1, 0)
        total = np.cumsum(step)
        # An opening bracket and what it holds share a depth; so does the closing one.
        self.depth = total + np.where(step < 0, 1, 0)
        self.ok = bool(raw.size) and not inside[-1] and (total.size == 0 or (total[-1] == 0 and total.min() >= 0))
        self.close: dict[int, int] = {}
        if self.ok:
            o = np.flatnonzero(step > 0)
            c = np.flatnonzero(step < 0)
            o = o[np.argsort(self.depth[o], kind="stable")]
            c = c[np.argsort(self.depth[c], kind="stable")]
            self.ok = o.size == c.size and bool(np.all(self.kind[o] + 2 == self.kind[c])) and bool(np.all(o < c))
            self.close = dict(zip(o.tolist(), c.tolist()))
        self.ok = self.ok and self._whole()

    def _whole(self) -> bool:
        """Every span between structural bytes is what JSON allows there."""
        text, pos, kind = self.text, self.pos.tolist(), self.kind.tolist()
        if not pos:
            return self._value(text)
        if text[: pos[0]].strip(_WS) or text[pos[-1] + 1 :].strip(_WS) or kind[0] not in b"{[" or self.close.get(0) != len(pos) - 1:
            return False
        stack: list[int] = []
        want_key = want_value = False  # of the innermost object: a key must come; of any: a value must come
        for i, k in enumerate(kind):
            span = text[pos[i - 1] + 1 : pos[i]].strip(_WS) if i else b""
            before = kind[i - 1] if i else 0
            if k in b"{[":
                if span or (stack and (want_key or before in b"}]")):
                    return False
                stack.append(k)
                want_key, want_value = k == 0x7B, False
                continue
            if not stack:
                return False
            obj = stack[-1] == 0x7B
            if k == 0x3A:
                if not obj or not want_key or not _STRING.match(span):
                    return False
                want_key, want_value = False, True
                continue
            if span:
                if before in b"}]" or (obj and want_key) or not self._value(span):
                    return False
            elif before not in b"}]" and not (k in b"}]" and before in b"{["):
                return False
            if k == 0x2C:
                want_key, want_value = obj, not obj
            else:
                stack.pop()
                want_key = want_value = False
        return not stack

    @staticmethod
    def _value(span: bytes) -> bool:
        span = span.strip(_WS)
        if span[:1] == b'"':
            try:
                span.decode("utf-8")
            except UnicodeDecodeError:
                return False
            return bool(_STRING.match(span))
        return bool(_SCALAR.match(span))

    def children(self, at: int) -> Iterator[tuple[bytes, int, int, int]]:
        """(key, index of the child's opening mark or -1, span start, span end)
        of the container opened at mark ``at``; the key is empty in a list."""
        end = self.close[at]
        i, start, key = at + 1, int(self.pos[at]) + 1, b""
        nested = -1
        while i <= end:
            k = self.kind[i]
            if k in b"{[":
                nested, i = i, self.close[i] + 1
                continue
            stop = int(self.pos[i])
            if k == 0x3A:
                key, start = self.text[start:stop].strip(_WS), stop + 1
            else:
                if nested >= 0 or self.text[start:stop].strip(_WS):
                    yield key, nested, start, stop
                key, nested, start = b"", -1, stop + 1
            i += 1


def _string(index: StructuralIndex, child: tuple[bytes, int, int, int] | None) -> str:
    """A child's text as stored; null, absent and nested values give ''."""
    if child is None or child[1] >= 0:
        return ""
    span = index.text[child[2] : child[3]].strip(_WS)
    if span == b"null":
        return ""
    if span[:1] != b'"':
        return span.decode()
    return span[1:-1].decode() if b"\\" not in span else json.loads(span)


def _members(index: StructuralIndex, at: int) -> dict[str, tuple[bytes, int, int, int]]:
    return {(json.loads(c[0]) if b"\\" in c[0] else c[0][1:-1].decode()): c for c in index.children(at)}


def _elements(index: StructuralIndex, child: tuple[bytes, int, int, int] | None) -> list[tuple[int, tuple[bytes, int, int, int]]]:
    """(position, element) of a list, of a single value as a list of one; null
    elements are left out but keep their place."""
    if child is None:
        return []
    if child[1] >= 0 and index.kind[child[1]] == 0x5B:
        items = list(enumerate(index.children(child[1])))
    else:
        items = [(0, child)]
    return [(i, c) for i, c in items if c[1] >= 0 or index.text[c[2] : c[3]].strip(_WS) != b"null"]


def storyboard_rows(payload: str | None) -> list[tuple[str, int, int, int, str]]:
    """(level, chapter, event, item, key) of every child of one storyboard text.

    Null, blank, broken or trailing text, and text whose top value is no object,
    give no rows. A member named twice counts with its last value.
    """
    if not payload:
        return []
    text = payload.lstrip("﻿").strip().encode("utf-8", "surrogatepass")
    if text[:1] != b"{":
        return []
    ix = StructuralIndex(text)
    if not ix.ok:
        return []
    out: list[tuple[str, int, int, int, str]] = []
    top = _members(ix, 0)
    for ci, chapter in _elements(ix, top.get("chapters")):
        members = _members(ix, chapter[1]) if chapter[1] >= 0 and ix.kind[chapter[1]] == 0x7B else {}
        out.append(("chapter", ci, -1, -1, _string(ix, members.get("chapter_id"))))
        for ei, event in _elements(ix, members.get("events")):
            fields = _members(ix, event[1]) if event[1] >= 0 and ix.kind[event[1]] == 0x7B else {}
            out.append(("event", ci, ei, -1, _string(ix, fields.get("event_id"))))
            for pi, person in _elements(ix, fields.get("characters_in_event")):
                inner = _members(ix, person[1]) if person[1] >= 0 and ix.kind[person[1]] == 0x7B else {}
                name = _string(ix, inner.get("name")) if inner else _string(ix, person)
                out.append(("character", ci, ei, pi, name))
            for ki, frame in _elements(ix, fields.get("key_frame_times")):
                out.append(("key_frame", ci, ei, ki, _string(ix, frame)))
    return out


def json_children(raw: DataFrame, tbl: str = "raw_storyboards") -> DataFrame:
    """Child rows of ``payload`` JSON texts, one Arrow batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("tbl", pa.string()), ("level", pa.string()), ("run_id", pa.string()), ("chapter_pos", pa.int32()), ("event_pos", pa.int32()), ("item_pos", pa.int32()), ("child_key", pa.string())]
        )
        for batch in batches:
            rows = [(r, *x) for r, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in storyboard_rows(p)]
            if rows:
                run_id, level, ci, ei, ii, key = (list(c) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tbl] * len(rows)), pa.array(level), pa.array(run_id, pa.string()), pa.array(ci, pa.int32()), pa.array(ei, pa.int32()), pa.array(ii, pa.int32()), pa.array(key)], schema=schema
                )

    return raw.select("run_id", "payload").mapInArrow(run, CHILD_SCHEMA)


def _child(tbl: str, level: str, chapter: Column, event: Column | None, item: Column | None, key: Column) -> list[Column]:
    none = F.lit(-1)
    return [
        F.lit(tbl).alias("tbl"), F.lit(level).alias("level"), F.col("run_id"),
        chapter.cast("int").alias("chapter_pos"),
        (none if event is None else event).cast("int").alias("event_pos"),
        (none if item is None else item).cast("int").alias("item_pos"),
        F.coalesce(key, F.lit("")).alias("child_key"),
    ]


def chapter_children(polished: DataFrame) -> DataFrame:
    """Chapters and events of the polished storyboards, from one pass."""
    tbl = "stage3_polished"
    # Only the two keys travel: the scan reads chapters.chapter_id and chapters.events.event_id.
    slim = F.transform(
        "chapters",
        lambda c: F.when(c.isNotNull(), F.struct(c["chapter_id"].alias("k"), F.transform(c["events"], lambda e: F.when(e.isNotNull(), F.struct(e["event_id"].alias("k")))).alias("es"))),
    )
    base = polished.select("run_id", F.posexplode(slim).alias("ci", "c")).where(F.col("c").isNotNull())
    own = F.array(F.struct(F.lit("chapter").alias("level"), F.lit(-1).alias("ei"), F.col("c.k").alias("k")))
    below = F.transform(
        F.coalesce(F.col("c.es"), F.array().cast("array<struct<k:string>>")),
        lambda e, i: F.when(e.isNotNull(), F.struct(F.lit("event").alias("level"), i.alias("ei"), e["k"].alias("k"))),
    )
    rows = base.select("run_id", "ci", F.explode(F.concat(own, below)).alias("x")).where(F.col("x").isNotNull())
    return rows.select(
        F.lit(tbl).alias("tbl"), F.col("x.level").alias("level"), "run_id", F.col("ci").cast("int").alias("chapter_pos"),
        F.col("x.ei").cast("int").alias("event_pos"), F.lit(-1).cast("int").alias("item_pos"), F.coalesce("x.k", F.lit("")).alias("child_key"),
    )


def event_children(final: DataFrame) -> DataFrame:
    """Characters and key frames of the chapter table's events, from one pass."""
    kind = "struct<level:string,ii:int,k:string>"
    base = final.select("run_id", F.col("ch_idx").alias("ci"), F.posexplode("events").alias("ei", "e")).where(F.col("e").isNotNull())
    empty = F.array().cast(f"array<{kind}>")
    people = F.coalesce(
        F.transform(
            F.col("e.characters_in_event"),
            lambda p, i: F.when(p.isNotNull(), F.struct(F.lit("character").alias("level"), i.alias("ii"), p["name"].alias("k"))),
        ),
        empty,
    )
    frames = F.coalesce(
        F.transform(
            F.col("e.key_frame_times"),
            lambda t, i: F.when(t.isNotNull(), F.struct(F.lit("key_frame").alias("level"), i.alias("ii"), t.alias("k"))),
        ),
        empty,
    )
    rows = base.select("run_id", "ci", "ei", F.explode(F.concat(people, frames)).alias("x")).where(F.col("x").isNotNull())
    return rows.select(
        F.lit("pass3_final").alias("tbl"), F.col("x.level").alias("level"), "run_id", F.col("ci").cast("int").alias("chapter_pos"),
        F.col("ei").cast("int").alias("event_pos"), F.col("x.ii").cast("int").alias("item_pos"), F.coalesce("x.k", F.lit("")).alias("child_key"),
    )


def all_children(polished: DataFrame, final: DataFrame, raw: DataFrame) -> DataFrame:
    """Every child row of the three tables, each once however often a parent
    was delivered. Null and empty lists give no rows; empty tables none."""
    return chapter_children(polished).unionByName(event_children(final)).unionByName(json_children(raw)).dropDuplicates()
