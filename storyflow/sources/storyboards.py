"""Storyboards as files: reading tolerant JSON, writing one document a video."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_KNOWN = (
    "event_id:string,start_time:string,end_time:string,step1_objective_visual:string,step2_contextual_reasoning:string,step3_synthesized_dense_caption:string,"
    "characters_in_event:array<struct<name:string,desc:string>>,key_frame_times:array<string>,frame_caption:string,frame_timestamps:array<double>,final_caption:string"
)
#: An event's named members in their order.
MEMBERS = (
    "event_id", "start_time", "end_time", "step1_objective_visual", "step2_contextual_reasoning", "step3_synthesized_dense_caption",
    "characters_in_event", "key_frame_times", "frame_caption", "frame_timestamps", "final_caption",
)
#: ``other`` holds the members no schema names, each as JSON text.
EVENT = f"struct<{_KNOWN},other:map<string,string>>"
_CHAPTER = "chapter_id:string,title:string,chapter_summary:string,start_time:string,end_time:string"
STORYBOARD = f"video_path string, video_summary string, chapters array<struct<{_CHAPTER},events:array<{EVENT}>>>"
_RAW = f"video_path string, video_summary string, chapters array<struct<{_CHAPTER},events:array<string>>>"


def _event(text: Column) -> Column:
    """An event of its JSON text; null for null, all members null for no object."""
    known = F.from_json(text, f"struct<{_KNOWN}>")
    every = F.from_json(text, "map<string,variant>")
    other = F.transform_values(F.map_filter(every, lambda k, v: ~k.isin(*MEMBERS)), lambda k, v: F.to_json(v))
    return F.when(text.isNotNull(), F.struct(*[known[m].alias(m) for m in MEMBERS], other.alias("other")))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Storyboard documents of a folder, one row each, with the file they stand
    in; a file that is no JSON object gives a row of nulls, never a failure.
    Members of an event that no schema names are kept in its ``other``; those of
    a chapter or document are dropped."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    parsed = raw.select(F.col("_metadata.file_path").alias("file"), F.from_json("value", _RAW, {"mode": "PERMISSIVE"}).alias("s")).select("file", "s.*")
    own = [f.split(":")[0] for f in _CHAPTER.split(",")]

    def chapter(c: Column) -> Column:
        return F.when(c.isNotNull(), F.struct(*[c[m].alias(m) for m in own], F.transform(c["events"], _event).alias("events")))

    return parsed.withColumn("chapters", F.transform("chapters", chapter))


def _in_order(rows: Column, by: str) -> Column:
    return F.array_sort(rows, lambda a, b: (a[by] - b[by]).cast("int"))


def nest(events: DataFrame, chapters: DataFrame, videos: DataFrame, key: str = "video_id") -> DataFrame:
    """(key, video_path, video_summary, chapters): flat tables as documents.

    ``events`` has the event members, ``other`` if there are any, key, ch_idx and
    ord; ``chapters`` key, ch_idx and the chapter members; ``videos`` key,
    video_path, video_summary. A chapter without events stays, with an empty list.
    """
    have = F.struct(*[(F.col(m) if m in events.columns else F.lit(None)).alias(m) for m in (*MEMBERS, "other")]).cast(EVENT)
    inner = events.groupBy(key, "ch_idx").agg(_in_order(F.collect_list(F.struct("ord", have.alias("e"))), "ord").alias("es"))
    c = chapters.join(inner, [key, "ch_idx"], "left")
    own = F.struct("chapter_id", "title", "chapter_summary", "start_time", "end_time", F.coalesce(F.transform("es", lambda x: x["e"]), F.array().cast(f"array<{EVENT}>")).alias("events"))
    g = c.groupBy(key).agg(_in_order(F.collect_list(F.struct("ch_idx", own.alias("c"))), "ch_idx").alias("cs"))
    out = videos.join(g, key, "left")
    return out.select(key, "video_path", "video_summary", F.coalesce(F.transform("cs", lambda x: x["c"]), F.array()).alias("chapters"))


def _with_member(head: Column, name: str, items: Column) -> Column:
    """A JSON object's text with one more member, a list of JSON texts."""
    listed = F.concat(F.lit("["), F.array_join(items, ",", "null"), F.lit("]"))
    return F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(f',"{name}":'), F.coalesce(listed, F.lit("null")), F.lit("}"))


def to_json(video_path: Column, video_summary: Column, chapters: Column) -> Column:
    """A document's JSON text, with the unnamed members of events beside the
    named ones; nulls are written."""
    whole = {"ignoreNullFields": "false"}

    def event(e: Column) -> Column:
        known = F.to_json(F.struct(*[e[m].alias(m) for m in MEMBERS]), whole)
        quoted = lambda k: F.regexp_extract(F.to_json(F.array(k)), r"(?s)^\[(.*)\]$", 1)
        more = F.transform(F.map_entries(e["other"]), lambda x: F.concat(quoted(x["key"]), F.lit(":"), x["value"]))
        spliced = F.concat(F.substring(known, F.lit(1), F.length(known) - 1), F.lit(","), F.array_join(more, ","), F.lit("}"))
        return F.when(e.isNotNull(), F.when(F.size(more) > 0, spliced).otherwise(known))

    def chapter(c: Column) -> Column:
        head = F.to_json(F.struct(*[c[m].alias(m) for m in (f.split(":")[0] for f in _CHAPTER.split(","))]), whole)
        return F.when(c.isNotNull(), _with_member(head, "events", F.transform(c["events"], event)))

    head = F.to_json(F.struct(video_path.alias("video_path"), video_summary.alias("video_summary")), whole)
    return _with_member(head, "chapters", F.transform(chapters, chapter))


def write(documents: DataFrame, path: str, key: str = "video_id") -> None:
    """One JSON line for each document, in a folder for each key."""
    text = to_json(F.col("video_path"), F.col("video_summary"), F.col("chapters"))
    documents.select(key, text.alias("value")).write.mode("overwrite").partitionBy(key).text(path)
