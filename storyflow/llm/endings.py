"""Texts that break off: structure, terminators and learned sentence endings.

A stack automaton over brackets, quotes, fences, tags, list items, escapes and
multi-byte sequences finds what was opened anywhere in a value without a final
terminator and never closed. What closes all it opens is held against a baseline of endings: the
(beginning, ending) frames of all sentences of all values that are known to be
whole, because a further sentence or a full stop follows. Frames are counted in
each batch before any shuffle and matched by key, so neither the corpus nor the
baseline is ever collected or broadcast.

An end that looks whole but lacks its full stop is judged by its source: where
such ends are about as rare, beside the source's cuts, as cuts that fall just
before a full stop must be, the source ends its sentences and the value was cut;
where they are more, the source leaves full stops out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..common import cut
from .texts import CLAUSE, NAME, SENTENCES, WORD, key, no_answer

_TERMINAL = ".!?。！？"
_CLOSERS = "\"'”’»」』)]）】›"
# Remarks that may stand after a whole sentence.
_REMARK = r"(?:fin|the end|end|ende|fine|final|cont(?:inued|\.)?|to be continued|weiter|fortsetzung|sigue|continúa|continuación|suite|à suivre|продолжение|конец|完|续|接上|未完待续)"
_EMOJI = "\U0001f000-\U0001faff☀-➿⬀-⯿️‍♪-♯"
_AFTER = re.compile(rf"(?:\s|[​-‏﻿]|[{_EMOJI}♪*_~`]|[(（]{_REMARK}[)）]|[\[【]{_REMARK}[\]】]|[\"'”’»」』›])+$", re.I)
_BREAK = re.compile(r"(?:\s*(?:\[\s*(?:\.\.\.|…)\s*\]|\(\s*(?:\.\.\.|…)\s*\)|\.{2,}|…+|。。+))+$")
_PAIRS = {"[": "]", "(": ")", "{": "}", "【": "】", "「": "」", "『": "』", "（": "）", "“": "”", "«": "»", "„": "“", "《": "》", "<": ">"}
_CLOSE = {c: o for o, c in _PAIRS.items() if o not in "„<"}
_MARK = re.compile(r"```|<(?P<close>/?)(?P<tag>[A-Za-z][A-Za-z0-9]*)[^<>]*>|</?[A-Za-z][^<>]*\Z|[\"\[\](){}【】「」『』（）“”„«»《》]")
# Tags that are whole without a closing one.
_LONE = {f"<{t}>" for t in "area base br col embed hr img input li link meta option p param source td th tr track wbr".split()}
#: A list item that was begun and not written, at the end of a text.
_ITEM = re.compile(r"\n\s*(?:[-*•–]|[0-9]{1,3}[.)、．）]|[A-Za-z][.)])\s*\Z")
_ESCAPE_CUT = re.compile(r"(?:\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?)?|&(?:#[0-9]{0,6}|[A-Za-z]{1,8})|%[0-9A-Fa-f]?)$")


def unclosed(text: str) -> list[tuple[str, int]]:
    """(mark, place) of what is opened and not closed, by a stack automaton
    over brackets, double quotes, guillemets, code fences and tags. A quote that
    opens again at the start of a line goes on; a straight quote behind a word
    or number (an inch) or at the very end opens none; tags that nobody closes
    count for nothing.
    """
    stack: list[tuple[str, int]] = []
    end = len(text.rstrip())
    open_now: Counter[str] = Counter()

    def push(mark: str, at: int) -> None:
        stack.append((mark, at))
        open_now[mark] += 1

    def pop(*marks: str) -> bool:
        """Close the nearest of the marks, and with it what was opened inside."""
        if not any(open_now[m] for m in marks):
            return False
        while True:
            mark, _ = stack.pop()
            open_now[mark] -= 1
            if mark in marks:
                return True

    for m in _MARK.finditer(text):
        c, i = m[0], m.start()
        before, after = text[i - 1 : i], text[m.end() : m.end() + 1]
        if c == "```":
            pop(c) or push(c, i)
        elif c[0] == "<":
            name = f"<{m['tag'].lower()}>" if m["tag"] else "<"
            if m["close"]:
                pop(name)
            elif name not in _LONE and not c.endswith("/>"):
                push(name, i)
        elif c == '"':
            if open_now[c]:
                if before not in ("", "\n") or not after.isalnum():
                    pop(c)
            elif i + 1 < end and (not before.isalnum() or after.isalnum()):
                push(c, i)
        elif c == "“":
            if not pop("„") and not (open_now[c] and before in ("", "\n")):
                push(c, i)
        elif c == "”":
            pop("“", "„")
        elif c in "«»":
            if not pop("»" if c == "«" else "«") and (c == "«" or not before.strip() and after.isalnum()):
                if not (open_now[c] and before in ("", "\n")):
                    push(c, i)
        elif c in _PAIRS:
            push(c, i)
        else:
            pop(_CLOSE[c])
    return stack


def _bare(text: str) -> str:
    """A text without what may stand after its end: blanks, closing quotes,
    signs, remarks that it ends, dots of omission. Only its last stretch is
    looked at, and again while all of that falls away."""
    plain = text.rstrip()
    if plain[-1:] in _TERMINAL and plain[-2:] not in ("..", "。。"):
        return plain
    while text:
        stretch = text[-96:]
        kept = _AFTER.sub("", stretch)
        if m := _BREAK.search(kept):
            kept = _AFTER.sub("", kept[: m.start()])
        text = text[: len(text) - len(stretch)] + kept
        if kept:
            return text
    return text


def sentence_frames(s: str) -> tuple[str, str, str, str] | None:
    """The frames of one sentence with its names masked: its beginning with its
    ending, its last clause's beginning with its ending, its beginning with its
    last word, and its last three words. Names count as one word; a name alone
    is no sentence."""
    words = WORD.findall(s.lower())
    if words.count("〇") == len(words):
        return None
    head, tail = " ".join(words[:2]), " ".join(words[-2:])
    clause = WORD.findall(CLAUSE.split(s.rstrip(",;:，；：、 "))[-1].lower())[:2]
    return f"s{head}|{tail}", f"c{' '.join(clause)}|{tail}", f"w{head}|{words[-1]}", f"e{' '.join(words[-3:])}"


#: The keys under which the number of sentences and of their characters is kept.
TOTAL, LENGTH = key("all sentences"), key("all characters")
#: Ends without a full stop that look whole, as a multiple of the cuts that fall there by chance, from which they are a source's habit.
HABIT = 2.0
#: A frame belongs to the baseline from this share of all sentences on.
LEAST_SHARE = 1e-5


class Endings:
    """Collects whole sentences and tells what a value's end is."""

    def __init__(self) -> None:
        self.seen: Counter[str] = Counter()
        self.total = self.length = 0

    def read(self, text: str) -> tuple[str, list[int] | None]:
        """("blank" | "whole" | "cut" | "open", keys of an open end). Learns
        from all sentences that are known to be whole."""
        if no_answer(text):
            return "blank", None
        item = _ITEM.search(text)
        bare = _bare(text[: item.start()] if item else text)
        ends = bare.rstrip(_CLOSERS)
        if not ends:
            return "blank", None
        if ends[-1] in _TERMINAL:
            self._learn(p for p in SENTENCES.split(NAME.sub(" 〇 ", text)) if p)
            return "whole", None
        parts = [p for p in SENTENCES.split(NAME.sub(" 〇 ", bare)) if p]
        sentence = parts.pop() if parts else ""
        self._learn(parts)
        if bare[-1] == "�" or _ESCAPE_CUT.search(bare[-12:]):
            return "cut", None
        if item or bare[-1] in ",;:，；：、-–—" or unclosed(NAME.sub(" 〇 ", text)):
            return "cut", None
        f = sentence_frames(sentence)
        return ("open", [key(x) for x in f]) if f else ("cut", None)

    def _learn(self, sentences: Iterable[str]) -> None:
        """A sentence counts once for a text: a text that repeats a fragment
        does not make it an ending."""
        own = set(sentences)
        self.seen.update(own)
        self.total += len(own)
        self.length += sum(map(len, own))

    def drain(self) -> list[tuple[int, int]]:
        """(key, count) of the frames of all sentences since the last call."""
        frames: Counter[str] = Counter()
        for s, n in self.seen.items():
            for x in sentence_frames(s) or ():
                frames[x] += n
        out = [(key(k), n) for k, n in frames.items()] + [(TOTAL, self.total), (LENGTH, self.length)]
        self.seen.clear()
        self.total = self.length = 0
        return out


ROW = pa.schema(
    [("what", pa.string()), ("field", pa.string()), ("run_id", pa.string()), ("item_id", pa.string()), ("source", pa.string()), ("keys", pa.list_(pa.int64())), ("key", pa.int64()), ("n", pa.int64())]
)
ROW_DDL = "what string, field string, run_id string, item_id string, source string, keys array<bigint>, key bigint, n bigint"


def rows(items: list[tuple], frames: list[tuple[int, int]]) -> pa.RecordBatch:
    """One batch of judged values (what, field, run, item, source, keys) and frame counts."""
    n, k = len(items), len(frames)
    cols = [[x[i] for x in items] + [("frame" if i == 0 else None)] * k for i in range(6)]
    cols += [[None] * n + [f[0] for f in frames], [None] * n + [f[1] for f in frames]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ROW)], schema=ROW)


_ITEM_KEY = ["field", "run_id", "item_id"]


def judge_open(marked: DataFrame, least_share: float = LEAST_SHARE, habit: float = HABIT) -> DataFrame:
    """The open ends of ``marked`` that broke off: (field, run_id, item_id,
    source).

    An end looks whole if its last three words end sentences elsewhere and one
    of its frames with a beginning does so too, each often enough; what is often
    enough is a share of the corpus's sentences. One that does not look whole
    broke off. One that does broke off too if its source ends its sentences: if
    such ends are at most ``habit`` times the share of its cuts that falls just
    before a full stop by chance, one in the mean length of a sentence. Only the
    number and the length of all sentences come to the driver; a null source is
    a source of its own.
    """
    counts = marked.where("what = 'frame'")
    sums = counts.where(F.col("key").isin(TOTAL, LENGTH)).agg(*[F.sum(F.when(F.col("key") == k, F.col("n"))) for k in (TOTAL, LENGTH)]).first()
    total, length = sums[0] or 0, sums[1] or 0
    least = max(1, int(least_share * total))
    baseline = counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key")
    ends = marked.where("what = 'open'").select(*_ITEM_KEY, "source", "keys").dropDuplicates(_ITEM_KEY)
    asked = ends.select(*_ITEM_KEY, "source", F.posexplode("keys").alias("i", "key"))
    hit = asked.join(baseline.withColumn("known", F.lit(1)), "key", "left")
    known = lambda i: F.max(F.when(F.col("i") == i, F.coalesce("known", F.lit(0))))
    told = hit.groupBy(*_ITEM_KEY, "source").agg(*[known(i).alias(f"k{i}") for i in range(4)])
    told = cut(told.select(*_ITEM_KEY, "source", ((F.col("k3") == 1) & (F.col("k0") + F.col("k1") + F.col("k2") > 0)).alias("looks")))
    sure = marked.where("what = 'cut'").select(*_ITEM_KEY, "source").dropDuplicates(_ITEM_KEY)
    by_source = told.select("source", "looks").unionByName(sure.select("source", F.lit(False).alias("looks"))).groupBy("source")
    n = by_source.agg(F.count_if(F.col("looks")).alias("whole"), F.count_if(~F.col("looks")).alias("broken"))
    chance = F.col("broken") * (total / length if length else 0.0)
    ending = n.where((F.col("whole") > 0) & (F.col("whole") <= habit * chance)).select(F.col("source").alias("_source"))
    late = told.where("looks").join(ending, F.col("source").eqNullSafe(F.col("_source")), "left_semi")
    return told.where("NOT looks").unionByName(late).select(*_ITEM_KEY, "source")


def mark(values: DataFrame, whole: bool = False) -> DataFrame:
    """Every cut and open end and every whole sentence's frames, from one pass
    over (field, run_id, item_id, source, text); with ``whole`` also a row for
    each other value that is not blank."""

    def kept(what: str, text: str) -> bool:
        return what in ("cut", "open") or whole and (what == "whole" or any(c.isprintable() and not c.isspace() for c in text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings()
        for b in batches:
            items = []
            for field, run_id, item, source, text in zip(*(c.to_pylist() for c in b.columns)):
                what, keys = endings.read(text)
                if kept(what, text):
                    items.append((what, field, run_id, item, source, keys))
            yield rows(items, endings.drain())

    return values.where(F.col("text").isNotNull()).select("field", "run_id", "item_id", "source", "text").mapInArrow(run, ROW_DDL)


def _cut_ends(marked: DataFrame, least_share: float) -> DataFrame:
    sure = marked.where("what = 'cut'").select(*_ITEM_KEY, "source").dropDuplicates(_ITEM_KEY)
    return sure.unionByName(judge_open(marked, least_share)).dropDuplicates(_ITEM_KEY)


def truncated(values: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """(field, run_id, item_id, source) of each value that breaks off.

    Null, blank and "no answer" values are none; a value delivered again counts
    once; a value whose last sentence is whole is none, whatever stands after
    it. An empty table gives no rows; extra columns are dropped.
    """
    return _cut_ends(cut(mark(values)), least_share)


def rates(values: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """(field, source, n_values, n_unended, n_cut, share): how often each source
    cuts, beside how many of its values lack a final full stop at all, from one
    pass over the texts.

    Values that are null or blank are not counted; a value delivered again
    counts once; a null source is a source of its own.
    """
    marked = cut(mark(values, whole=True))
    each = marked.where("what <> 'frame'").groupBy(*_ITEM_KEY).agg(F.min("source").alias("source"), F.max(F.col("what").isin("cut", "open").cast("int")).alias("unended"))
    bad = _cut_ends(marked, least_share).select(*(F.col(c).alias(f"_{c}") for c in _ITEM_KEY), F.lit(1).alias("hit"))
    same = F.lit(True)
    for c in _ITEM_KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    n = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("bigint")
    out = each.join(bad, same, "left").groupBy("field", "source").agg(F.count(F.lit(1)).alias("n_values"), n("unended").alias("n_unended"), n("hit").alias("n_cut"))
    return out.withColumn("share", F.col("n_cut") / F.col("n_values"))


def caption_values(stage2: DataFrame, polished: DataFrame, final: DataFrame) -> DataFrame:
    """The three captioned fields as (field, run_id, item_id, source, text)."""
    a = stage2.select(F.lit("frame_caption").alias("field"), "run_id", F.col("event_id").alias("item_id"), "source", F.col("frame_caption").alias("text"))
    b = (
        polished.select("run_id", "source", F.explode("chapters.events").alias("es"))
        .select("run_id", "source", F.explode(F.arrays_zip(F.col("es.event_id").alias("i"), F.col("es.final_caption").alias("t"))).alias("e"))
        .select(F.lit("final_caption").alias("field"), "run_id", F.col("e.i").alias("item_id"), "source", F.col("e.t").alias("text"))
    )
    c = final.select(F.lit("chapter_summary").alias("field"), "run_id", F.col("chapter_id").alias("item_id"), "source", F.col("chapter_summary").alias("text"))
    return a.unionByName(b).unionByName(c)
