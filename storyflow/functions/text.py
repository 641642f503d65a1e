"""Text as Columns: names, file names, fenced JSON, single-pass rewriting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what is stripped from both sides of a name.
NAME_EDGE = "[]【】《》〈〉<>「」『』 \t\r\n"
MENTION = r"\[[^\[\]]+\]"


def normalize_name(x: Column) -> Column:
    """A name without surrounding brackets and blanks, in lower case; '' for null."""
    return F.coalesce(F.lower(F.btrim(F.btrim(x), F.lit(NAME_EDGE))), F.lit(""))


def mentions(x: Column) -> Column:
    """``[...]`` mentions in the order they first stand in the text, each once."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(MENTION), F.lit(0)))


def clean_json(x: Column) -> Column:
    """Model output without surrounding blanks and code fence. Prose around the
    fence stays."""
    edge = r"^\s+|\s+$"
    t = F.regexp_replace(x, edge, "")
    t = F.regexp_replace(t, "^```(?:json)?", "")
    t = F.regexp_replace(t, "```$", "")
    return F.regexp_replace(t, edge, "")


def sanitize(x: Column) -> Column:
    """A safe file name: forbidden and control characters become ``_``, outer
    blanks and dots go, nothing left gives ``unnamed``."""
    t = F.btrim(F.regexp_replace(x, r'[<>:"/\\|?*\x00-\x1f]', "_"), F.lit(" ."))
    return F.coalesce(F.nullif(t, F.lit("")), F.lit("unnamed"))


def quoted(x: Column) -> Column:
    """A literal as a piece of a Java pattern."""
    return F.concat(F.lit(r"\Q"), F.replace(x, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def any_of(keys: Column) -> Column:
    """Pattern for any of the keys: the longest first, equal lengths in the
    order given. Null for no keys."""
    ranked = F.array_sort(F.transform(keys, lambda k, i: F.struct((-F.length(k)).alias("n"), i.alias("i"), k.alias("k"))))
    return F.when(F.size(keys) > 0, F.array_join(F.transform(ranked, lambda r: quoted(r["k"])), "|"))


def rewrite(text: Column, pattern: Column, table: Column) -> Column:
    """Replace every match of ``pattern`` by its value in the map ``table`` in
    one pass, so that no value is rewritten again. Without a pattern the text
    stays as it is."""
    parts = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    # Zipped, so that neither list is made again for each element; the last part has no match after it.
    mixed = F.zip_with(parts, hits, lambda p, hit: F.concat(p, F.coalesce(F.try_element_at(table, F.coalesce(hit, F.lit(""))), F.lit(""))))
    return F.when(pattern.isNull() | text.isNull(), text).otherwise(F.array_join(mixed, ""))


def bounded_replace(text: Column, old: Column, new: Column) -> Column:
    """Replace ``old`` where no letter, digit or Han character adjoins it."""
    side = r"[\p{L}\p{N}_一-鿿]"
    pattern = F.concat(F.lit(f"(?<!{side})"), quoted(old), F.lit(f"(?!{side})"))
    value = F.regexp_replace(new, r"([\\$])", r"\\$1")
    return F.when(F.coalesce(old, F.lit("")) == "", text).when(old == new, text).otherwise(F.regexp_replace(text, pattern, value))


def signature(model: Column, chunk_sec: int, payload: str, frames: int, scene: float, width: int, overlap: int) -> Column:
    """The display name of a run's settings."""
    return F.concat(
        sanitize(model),
        F.lit(f"__chk{chunk_sec}s__{payload}__mf{frames}__sc{str(scene).replace('.', '_')}__fw{width}__ovlp{overlap}"),
    )


def run_dir(root: Column, path: Column, name: Column) -> Column:
    """The folder of one video's run: the root, the video's safe name without
    its last extension, the settings' name. A name that begins with its only dot
    has no extension."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"^(.*[^.].*)\.[^.]*$", "$1")
    return F.concat_ws("/", F.rtrim(root, F.lit("/")), sanitize(stem), name)
