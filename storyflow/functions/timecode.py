"""Timecodes as Columns: strict reading in milliseconds, lenient reading and
formatting in seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks and brackets that may surround a time.
EDGE = " \t\r\n 　﻿[](){}【】「」（）"
_STRICT = r"^[0-9]{2,}:[0-5][0-9]:[0-5][0-9](\.[0-9]{1,3})?$"
#: The form as it stands or in square brackets.
_PLAIN = r"^\[?[0-9]{2,}:[0-5][0-9]:[0-5][0-9](\.[0-9]{1,3})?\]?$"
#: The same form inside a longer text, not glued to further digits or parts.
_INSIDE = r"(?<![0-9:.])[0-9]{2,}:[0-5][0-9]:[0-5][0-9](?:\.[0-9]{1,3})?(?![0-9:.])"


def plain_ms(t: Column) -> Column:
    """Milliseconds of a time text that has the strict form as it stands; null
    for an hour count beyond 2e9."""
    hours = F.substring_index(t, ":", 1)
    h = F.length(hours)
    part = lambda at, n: F.substring(t, h + at, F.lit(n)).try_cast("bigint")
    ms = F.coalesce(F.rpad(F.substring(t, h + 8, F.lit(3)), 3, "0").try_cast("bigint"), F.lit(0))
    count = hours.try_cast("bigint")
    return F.when(count <= 2_000_000_000, count * 3_600_000 + part(2, 2) * 60_000 + part(5, 2) * 1_000 + ms)


def readable_ms(x: Column) -> Column:
    """Milliseconds of a readable time ``HH:MM:SS[.mmm]``, else null.

    Surrounding blanks and brackets are ignored; two or more digits of hours,
    minutes and seconds below 60, at most three decimals. Null, blank, ``61``
    minutes, two-part times and words give null; an hour count beyond 2e9 too.
    """
    t = F.btrim(x, F.lit(EDGE))
    # Nearly all stand in brackets or bare; only the others are trimmed of every edge character.
    return F.when(x.rlike(_PLAIN), plain_ms(F.btrim(x, F.lit("[]")))).when(t.rlike(_STRICT), plain_ms(t))


def range_texts(x: Column) -> Column:
    """The two times a range text holds, as texts, null unless it holds exactly
    two (``[a] - [b]``, ``a–b`` and ``a-b`` alike)."""
    both = F.regexp_extract_all(x, F.lit(_INSIDE), F.lit(0))
    return F.get(F.filter(F.array(both), lambda y: F.size(y) == 2), F.lit(0))


def readable_range_ms(x: Column) -> tuple[Column, Column]:
    """The two readable times of a range text, both null unless it holds
    exactly two."""
    both = range_texts(x)
    return plain_ms(F.get(both, F.lit(0))), plain_ms(F.get(both, F.lit(1)))


def parse_seconds(x: Column) -> Column:
    """Lenient seconds as double: anything unreadable is 0.0.

    Outer brackets and spaces are stripped, exactly three ``:`` parts are
    needed, the third is split at points: first piece whole, second as decimal
    fraction, further ones ignored. No range checks: minute 75 and negatives pass.

    A text of plain digits, as nearly all are, is read without splitting.
    """
    t = F.btrim(x, F.lit("[] "))
    return F.when(t.rlike(_DIGITS), _digit_seconds(t)).otherwise(_any_seconds(x))


#: Three parts of plain digits, the last with a plain fraction or none.
_DIGITS = r"^[0-9]{1,15}:[0-9]{1,15}:[0-9]{1,15}(\.[0-9]{1,15})?$"


def _digit_seconds(t: Column) -> Column:
    number = lambda c: c.cast("bigint").cast("double")
    last = F.substring_index(t, ":", -1)
    frac = F.when(F.contains(t, F.lit(".")), F.concat(F.lit("0."), F.substring_index(t, ".", -1)).cast("double")).otherwise(F.lit(0.0))
    return number(F.substring_index(t, ":", 1)) * 3600 + number(F.substring_index(F.substring_index(t, ":", 2), ":", -1)) * 60 + number(F.substring_index(last, ".", 1)) + frac


def _any_seconds(x: Column) -> Column:
    whole = r"^\s*[+-]?[0-9]+\s*$"
    p = F.split(F.btrim(x, F.lit("[] ")), ":", -1)
    sec = F.split(F.get(p, F.lit(2)), r"\.", -1)

    def integer(c: Column) -> Column:
        return F.when(c.rlike(whole), F.trim(c).try_cast("bigint")).cast("double")

    frac = F.when(F.size(sec) > 1, F.concat(F.lit("0."), F.get(sec, F.lit(1))).try_cast("double")).otherwise(F.lit(0.0))
    value = integer(F.get(p, F.lit(0))) * 3600 + integer(F.get(p, F.lit(1))) * 60 + integer(F.get(sec, F.lit(0))) + frac
    return F.coalesce(F.when(F.size(p) == 3, value), F.lit(0.0))


def format_seconds(sec: Column) -> Column:
    """``[HH:MM:SS]`` of the whole second nearest to ``sec``, halves to even."""
    s = F.bround(sec, 0).cast("bigint")
    return F.format_string("[%02d:%02d:%02d]", F.expr("0") + F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))


def format_millis(sec: Column) -> Column:
    """``[HH:MM:SS.mmm]``, milliseconds halves to even; a fraction that rounds
    to a full second is carried into the seconds."""
    whole = F.floor(sec)
    ms = F.bround((sec - whole) * 1000, 0).cast("bigint")
    s = whole + F.when(ms >= 1000, 1).otherwise(0)
    ms = F.when(ms >= 1000, F.lit(0).cast("bigint")).otherwise(ms)
    return F.format_string("[%02d:%02d:%02d.%03d]", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)), ms)


def round_millis(x: Column) -> Column:
    """``x`` rounded to three decimals by its exact binary value, halves to even.

    ``bround`` rounds the shortest decimal text of a number, which differs where
    that text ends in a five that the number itself is not: 2.0005 is a little
    more than it says. Here the product with 1000 is split into its rounded value
    and its exact error, so that the nearest integer is known without doubt.
    """
    p = x * 1000.0
    c = x * 134217729.0  # halves of 26 bits, whose products with 1000 are exact
    high = c - (c - x)
    error = (high * 1000.0 - p) + (x - high) * 1000.0
    f = F.floor(p).cast("double")
    over = (p - f - 0.5) + error
    n = F.when(over > 0, f + 1).when(over < 0, f).otherwise(f + F.pmod(f, F.lit(2.0)))
    return F.when(F.abs(x) < 1e12, n / 1000.0).otherwise(x)
