"""Text decoded with the wrong encoding: finding it and getting it back.

A stretch of text is a state; encoding it with one codec and decoding the bytes
with another, or unescaping it, leads to other states. A best-first search
over these operations, guided by the cost of a text's characters and with the
states seen so far kept by hash, goes to the cheapest text in reach.
"""

from __future__ import annotations

import codecs
import heapq
import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Codecs a text may have been decoded with by mistake.
WRONG = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "koi8-r", "cp866", "cp932", "gb18030", "big5", "cp1250", "iso8859-15", "iso8859-5", "cp949", "mac_cyrillic")
#: Codecs a text may have been written in.
RIGHT = ("utf-8", "gb18030", "cp1251", "koi8-r", "cp1252", "cp866", "mac_roman", "cp437", "cp850", "big5", "cp932")

_DOUBLE = {"gb18030", "big5", "cp932", "cp949"}
_DOUBLE_WRONG = _DOUBLE | {"cp949"}
_CYRILLIC = {"cp1251", "koi8-r", "cp866"}
_PAIRED = re.compile(r"[^\x00-\x7f]{6}|[\u00a1\u00a8][\u00a1-\u00bf]|[^\x00-\x7f][0-9][^\x00-\x7f][0-9]")
_THREE = re.compile(r"[^\x00-\x7f]{3}")
_FIVE = "".join(map(chr, range(0x80, 0xA0)))
_C1 = re.compile(r"[\x80-\x84\x86-\x9f]")
_LOST = "�"
_VOWELS = set("аеёиоуыэюяіїє")
_WORD = re.compile(r"[^\W\d_]+")
_NON_ASCII = re.compile(r"[^\x00-\x7f]")
_RUN = re.compile(r"[A-Za-z]*[^\x00-\x7f]+(?:[ -~]{0,2}[^\x00-\x7f]+)*[A-Za-z]*")
_SEGMENT = re.compile(r"[^\n]*?(?:[.!?](?=\s|[^\x00-\x7f])|[。！？]|\n|$)", re.S)
_SIDES = re.compile(r"[\u2e80-\u9fff\uff00-\uff60]+|[^\u2e80-\u9fff\uff00-\uff60]+")
_STRAY_LETTER = re.compile(r"(?<![^\W\d_])(?=[\u0080-\u052f])[^\W\d_](?![^\W\d_])")
#: Anything but letters of the usual scripts and wide marks; without one no sign can be out of place.
_SIGN = re.compile(r"[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u052f\u3000-\u30ff\u3400-\u9fff\uac00-\ud7a3\uff00-\uff60]")
#: Marks right behind letters, or inside a word, that no writing puts there. The endings are those Spanish words have behind ñ and ó.
_OUT_OF_PLACE = re.compile(
    r"(?<=[^\W\d_])\u201a(?![^\W\d_]*[\u2018\u2019])|\u201a(?![^\u201a\u2018]*[\u2018\u2019])|(?<=[^\W\d_])[\u00a1\u00bf](?![A-Z\u00c0-\u00de])|(?<=[^\W\d_]{2})\u00b0(?!\d)"
    r"|(?<=[aeiou])\u2013(?=(?:os?|as?|or|ora|ores|ola?|ana|al|ad[ao])\b)|(?<=[a-z])\u2014(?=n\b)"
)
_GLUED = re.compile(r"[^\W\d_][^\w\s\x00-\x7f¡¿‘’ʼ…–—·‐‑\u00ad\u0300-\u036f\u3000-\u303f\uff00-\uff60\u200b-\u200d\ufe0f\U0001f000-\U0001faff\u2600-\u27bf\u2022]+(?=[^\W\d_])")
_SUMS = re.compile(r"[\u2190-\u22ff](?=[^\W\d_])|(?<=[^\W\d_])[\u2190-\u22ff]")
_HANGING = re.compile(r"(?<=\s)[–—](?=[^\W\d_])")
_RAISED = re.compile(r"(?<=[^\W\d_])[²³¹¼½¾ªº](?=[^\W\d_])")
#: A two-byte character of UTF-8 seen as two characters of Latin-1.
_PAIR = re.compile(r"[\u00c2-\u00df][\u0080-\u00bf]")
_SINGLES = set("àáâèéêìíîòóôùúûÀÁÂÈÉÊÌÍÎÒÓÔÙÚÛåøæöäüÅØÆÖÄÜß")


def _c1_bytes(e: UnicodeError):
    """Encode what a strict table leaves undefined as the raw C1 byte."""
    if isinstance(e, UnicodeEncodeError):
        part = e.object[e.start : e.end]
        if all(c in _FIVE for c in part):
            return bytes(map(ord, part)), e.end
    raise e


codecs.register_error("storyflow-c1", _c1_bytes)


@lru_cache(maxsize=65536)
def _han(c: str) -> float:
    """Common characters cost little: the first level of the national set."""
    try:
        b = c.encode("gb2312")
        return 0.01 if b[0] <= 0xD7 else 0.1
    except UnicodeEncodeError:
        try:
            c.encode("big5")
            return 0.4
        except UnicodeEncodeError:
            return 0.7


@lru_cache(maxsize=65536)
def _char(c: str) -> tuple[float, str]:
    """(cost, class) of one character outside ASCII."""
    o, cat = ord(c), unicodedata.category(c)
    if c == _LOST:
        return 2.0, "lost"
    if 0x80 <= o < 0xA0:
        return (0.3 if o == 0x85 else 2.0), "control"
    if cat in ("Co", "Cn", "Cs"):
        return 2.0, "private"
    if 0x4E00 <= o <= 0x9FFF:
        return _han(c), "han"
    if 0x3400 <= o <= 0x4DBF or 0xF900 <= o <= 0xFAFF:
        return 0.8, "han"
    if 0x0400 <= o <= 0x052F:
        return (0.0 if 0x0410 <= o <= 0x044F or c in "ёЁ" else 0.35 if c in "іїєґІЇЄҐўЎ" else 1.0), "cyr"
    if 0xFF61 <= o <= 0xFF9F:
        return 0.7, "halfkana"
    if 0x3040 <= o <= 0x30FF:
        return 0.05, "kana"
    if 0x3100 <= o <= 0x312F:
        return 0.7, "bopomofo"
    if 0xAC00 <= o <= 0xD7A3:
        return 0.05, "hangul"
    if 0x2500 <= o <= 0x25FF:
        return 0.8, "box"
    if o < 0x0250 and cat[0] == "L":
        return (0.02 if o < 0x100 or c in "œŒšŠžŽŸąćęłńśźżĄĆĘŁŃŚŹŻčďěňřťůČĎĚŇŘŤŮőűŐŰğışĞİŞ" else 0.5) if c not in "ªº" else 0.3, "latin"
    if 0x0300 <= o <= 0x036F:
        return (0.0 if o <= 0x030C or o in (0x0323, 0x0326, 0x0327, 0x0328, 0x0331) else 0.4), "mark"
    if 0x0370 <= o <= 0x03FF:
        return 0.3, "greek"
    if cat[0] == "L":
        return 0.6, "other"
    if c in "–—‘’‚“”„«»…‹›·•°€£¥§©®™½¼¾×÷±²³¹¿¡№→←↑↓☆★♪、。，！？；：（）【】「」『』《》〈〉～\u00a0\u3000\u200d\u200b\u200c\u2010\u2011\u2009\u202f\ufeff":
        return 0.02, "mark"
    if 0x1F000 <= o <= 0x1FAFF or 0x2600 <= o <= 0x27BF or 0xFE00 <= o <= 0xFE0F or 0xFF00 <= o <= 0xFF60:
        return 0.02, "mark"
    if c == "\u00ad":
        return 0.2, "mark"
    if cat[0] == "M":
        return 0.4, "mark"
    return (0.05 if cat == "Sm" and o >= 0x2200 or 0x2190 <= o <= 0x21FF else 0.35), "sign"


def _word_cost(w: str) -> float:
    """Cost of letters side by side that no writing puts there."""
    cost, classes, run = 0.0, set(), 0
    prev_lower = prev_cls = None
    for c in w:
        cls = "ascii" if c < "\x80" else _char(c)[1]
        if cls == "latin" and c < "\u0100":
            run += 1
            if run >= 3:
                cost += 0.1 if w.isupper() else 0.8
            elif run == 2 and not c.isupper():
                cost += 0.15
        else:
            run = 0
        base = "latin" if cls == "ascii" else cls
        classes.add(base)
        lower = c.islower()
        if c > "\x7f" or prev_cls not in (None, "ascii"):
            if c.isupper() and prev_lower:
                cost += 0.8  # a capital after a small letter, one of them outside ASCII
        prev_lower, prev_cls = lower, cls
    alphabets = classes & {"latin", "cyr", "greek", "other"}
    if len(alphabets) > 1:
        cost += 1.0
    if classes & {"halfkana"} and classes & {"han", "latin"}:
        cost += 0.5
    if classes & {"latin"} and classes & {"hangul"}:
        cost += 0.5
    if "cyr" in alphabets and len(w) >= 3:
        low = w.lower()
        worst = gap = 0
        for c in low:
            gap = 0 if c in _VOWELS else gap + 1
            worst = max(worst, gap)
        if not any(c in _VOWELS for c in low):
            cost += 0.6
        elif worst >= 5:
            cost += 0.6
        if low[0] in "ьъы":
            cost += 0.8
        if w[0].islower() and w[1:].isupper():
            cost += 0.8
    return cost


@lru_cache(maxsize=65536)
def _own(c: str) -> float:
    return _char(c)[0]


@lru_cache(maxsize=65536)
def _cached_word_cost(w: str) -> float:
    return _word_cost(w)


def cost(text: str, limit: float = float("inf")) -> float:
    """What the characters of a text and their neighbours speak against it; 0
    for plain text of any of the usual scripts. All parts are at least 0, so a
    sum beyond ``limit`` is returned as it stands."""
    if text.isascii():
        return 0.0
    total = sum(map(_own, _NON_ASCII.findall(text)))
    if total > limit:
        return total
    for w in _WORD.findall(text):
        if not w.isascii():
            total += _cached_word_cost(w) if len(w) <= 24 else _word_cost(w)
    if total > limit:
        return total
    if _SIGN.search(text):
        total += 0.7 * len(_RAISED.findall(text)) + 0.3 * len(_HANGING.findall(text)) + 0.4 * len(_SUMS.findall(text))
        total += 0.7 * len(_GLUED.findall(text)) + 0.5 * len(_PAIR.findall(text)) + 0.5 * len(_OUT_OF_PLACE.findall(text))
        if total > limit:
            return total
    for m in _STRAY_LETTER.finditer(text):
        c = m.group()
        if c > "\x7f" and _char(c)[1] in ("latin", "greek", "cyr"):
            if c in _SINGLES or _char(c)[1] == "cyr" and c.lower() in "аявискоу":
                before = text[: m.start()].rstrip(" ")[-1:]
                total += 0.5 if before.isdigit() else 0.06
            else:
                total += 0.5
    return total


def _encode(text: str, codec: str) -> bytes | None:
    if _LOST in text:
        return None  # its bytes are gone; one codec has a code for the mark itself
    try:
        return text.encode(codec, "storyflow-c1" if codec in ("cp1252", "cp1251", "cp1250") else "strict")
    except UnicodeError:
        return None


def _decode(data: bytes, codec: str) -> str | None:
    try:
        return data.decode(codec)
    except UnicodeError:
        return None


@lru_cache(maxsize=1)
def _byte_costs() -> tuple[tuple[str, ...], np.ndarray]:
    """(single-byte codecs, cost of each byte read by each of them)."""
    codecs_ = tuple(c for c in RIGHT if c != "utf-8" and c not in _DOUBLE)
    table = np.zeros((256, len(codecs_)))
    for j, codec in enumerate(codecs_):
        for b in range(128, 256):
            c = _decode(bytes([b]), codec)
            table[b, j] = 1e9 if c is None else 0.0 if c < "\x80" else _own(c)
    return codecs_, table


def neighbours(text: str, strong_only: bool = False, limit: float = float("inf")) -> Iterator[tuple[str, bool, tuple[str, str]]]:
    """(state, strong, (wrong, right)) one operation away; strong if multi-byte
    structure, not only a table of single bytes, confirms it. Those come first. Of the others
    those whose characters alone cost ``limit`` or more are left out; counts of
    bytes against a table of costs tell them without decoding.
    """
    if "&" in text and (plain := html.unescape(text)) != text:
        yield plain, False, ("", "")
    encoded: dict[bytes, str] = {}
    for wrong in WRONG:
        data = _encode(text, wrong)
        if data is not None and data not in encoded:
            encoded[data] = wrong
    for data, wrong in encoded.items():
        out = _decode(data, "utf-8")
        if out is not None and out != text:
            yield out, True, (wrong, "utf-8")
    if strong_only:
        return
    paired, three = bool(_PAIRED.search(text)), bool(_THREE.search(text))
    singles, table = _byte_costs()
    for data, wrong in encoded.items():
        costs = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ table
        for right, least in zip(singles, costs):
            # Latin text has single letters outside ASCII, which two-byte codecs cannot read.
            if least < limit and right != wrong and (wrong not in _DOUBLE_WRONG or three and right in _CYRILLIC):
                out = _decode(data, right)
                if out is not None and out != text:
                    yield out, False, (wrong, right)
        if paired:  # two-byte characters leave long stretches outside ASCII
            for right in _DOUBLE:
                out = _decode(data, right) if right in RIGHT and right != wrong else None
                if out is not None and out != text:
                    yield out, False, (wrong, right)


#: What an operation adds to a text's cost that no multi-byte structure confirms; after the first one more.
_STEP, _FURTHER = 0.1, 0.25


def search(text: str, strong_only: bool = False) -> tuple[str, float, float, bool]:
    """(best text, its cost, the first cost, strong): best-first over the operations.

    Every operation on a way has to lower the cost, its own share counted, or
    the way would only lead around. What the operations of a way cost is a lower
    bound of all states behind it, so the search ends when no bound is below the
    best cost found, or when a state is found that multi-byte structure confirms
    and whose characters are plain. No other limit ends it.
    """
    first = cost(text)
    best, best_cost, sure = text, first, False
    heap: list[tuple[float, int, str, float]] = [(first, 0, text, 0.0)]
    visited, n = {hash(text)}, 0
    while heap:
        c, _, state, way = heapq.heappop(heap)
        if way >= best_cost:
            continue
        weak = way + (_FURTHER if state is not text else _STEP)
        for out, strong, _ in neighbours(state, strong_only or weak >= best_cost, c - weak):
            if (h := hash(out)) in visited:
                continue
            visited.add(h)
            to = way if strong else weak
            oc = cost(out, c - to) + to
            if oc >= c - 1e-9:
                continue
            n += 1
            heapq.heappush(heap, (oc, n, out, to))
            if oc < best_cost:
                best, best_cost, sure = out, oc, strong
                if strong and oc - to <= 0.05 * len(_NON_ASCII.findall(out)) + 0.1:
                    return best, best_cost, first, sure
    return best, best_cost, first, sure


def _better(first: float, then: float, out: str) -> bool:
    return first - then >= 0.4 - 1e-9 and then <= 0.4 * first + 0.02 * len(out) ** 0.5


def _same_reading(parts: list[list], pair: tuple[str, str], options: dict[int, dict]) -> None:
    """Let the stretches of a text follow one reading: those it explains as well
    as their own best, and those too short to be told alone if it makes them
    plainer."""
    wrong, right = pair
    for i, (kept, made, s) in enumerate(parts):
        if i in options:
            if pair in options[i]:
                parts[i][1] = options[i][pair]
        elif made is kept and not s.isascii() and (data := _encode(s, wrong)) is not None:
            out = _decode(data, right)
            if out is None or out == s:
                continue
            gain = cost(s) - cost(out)
            if gain >= 0.0 if right == "utf-8" else gain >= 0.2:
                parts[i][1] = out


def restore(text: str, least: float = 0.45) -> tuple[bool, str]:
    """(affected, text with every stretch restored that could be).

    Stretches are sentences and lines, then the runs outside ASCII in one that
    holds right and wrong characters. A text is mostly read wrongly in one way:
    of the readings that explain a stretch about as well as the best, the one
    that explains most of the text is taken. A stretch whose bytes are lost
    keeps its replacement marks.
    """
    if text.isascii() and "&" not in text:
        return False, text
    affected = _LOST in text or bool(_C1.search(text))
    parts: list[list] = []  # what stood there, what stands there now, what was read
    whole: dict[int, tuple[float, bool]] = {}
    for m in _SEGMENT.finditer(text):
        kept = s = m.group()
        if "&" in s:
            s = html.unescape(s)  # entities are right, what they stand for may not be
        if s.isascii() or cost(s) < least - 1e-9:
            parts.append([kept, kept, s])
            continue
        best, then, first, sure = search(s)
        if _better(first, then, best):
            affected = True
            whole[len(parts)] = (then, sure)
            parts.append([kept, best, s])
            continue

        lost = _LOST in s  # beside lost bytes only what multi-byte structure confirms

        def one(r: re.Match, lost: bool = lost) -> str:
            nonlocal affected
            w = r.group()
            if cost(w) < least - 1e-9:
                return w
            b, t, f, _ = search(w, lost)
            if _better(f, t, b):
                affected = True
                return b
            return w

        mixed = "".join(_RUN.sub(one, side) for side in _SIDES.findall(s))
        parts.append([kept, kept if mixed == s else mixed, s])
    if whole:
        options: dict[int, dict] = {}
        score: dict[tuple[str, str], list[float]] = {}
        for i, (then, sure) in whole.items():
            s = parts[i][2]
            options[i] = {}
            for out, strong, pair in neighbours(s, sure, then + 0.15):
                weight = 0.0 if strong else _STEP
                c = cost(out, then + 0.15 - weight) + weight
                if c <= then + 0.15 and pair[0]:
                    options[i][pair] = out
                    has = score.setdefault(pair, [0.0, 0.0, 0.0])
                    has[0] += len(_NON_ASCII.findall(s))
                    has[1] -= round(c, 6)
                    has[2] += out == parts[i][1]
        if score:
            _same_reading(parts, max(score, key=lambda p: (score[p], -RIGHT.index(p[1]), -WRONG.index(p[0]))), options)
    return affected, "".join(made for _, made, _ in parts)


def garbled(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, restored) of each row whose text holds a stretch decoded with the
    wrong encoding; ``restored`` is the text with what could be got back.

    Only rows with a character outside ASCII or an entity leave the JVM. Null, empty and
    plain texts give no row; repeated rows each give their own; long texts are
    read whole, stretch by stretch; an empty table gives no rows; other columns
    are dropped at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                hit, fixed = restore(t)
                if hit:
                    keys.append(k)
                    texts.append(fixed)
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array(texts, pa.string())], names=[key, "restored"])

    rows = df.where(F.col(text).rlike(r"[^\x00-\x7f]|&#?\w{2,8};")).select(key, text)
    return rows.mapInArrow(run, f"{key} {dict(df.dtypes)[key]}, restored string")
