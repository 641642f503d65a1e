"""The tables of a data directory in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import load

#: What is read of nested tables, by use.
POLISHED_KEYS = "run_id string, chapters array<struct<chapter_id:string,events:array<struct<event_id:string>>>>"
POLISHED_CAPTIONS = "run_id string, source string, chapters array<struct<events:array<struct<event_id:string,final_caption:string>>>>"
FINAL_ITEMS = "run_id string, ch_idx int, events array<struct<characters_in_event:array<struct<name:string>>,key_frame_times:array<string>>>"
FINAL_PEOPLE = "run_id string, ch_idx int, events array<struct<start_time:string,characters_in_event:array<struct<name:string,desc:string>>>>"
POLISHED_FLAT = (
    "run_id string, chapters array<struct<chapter_id:string,title:string,events:array<struct<event_id:string,start_time:string,end_time:string,characters_in_event:array<struct<name:string>>>>>>"
)


def events(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Events of the progress table, each once (rows delivered again differ
    only in their arrival). Only the columns asked for are read."""
    cols = ["run_id", "chunk_i", "ev_i", *[c for c in columns if c not in ("run_id", "chunk_i", "ev_i")]]
    return load(spark, d, "pass1_progress").select(*cols).dropDuplicates(["run_id", "chunk_i", "ev_i"])


def pairs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Refined events, each once."""
    cols = ["run_id", "event_id", *[c for c in columns if c not in ("run_id", "event_id")]]
    return load(spark, d, "stage2_refined").select(*cols).dropDuplicates(["run_id", "event_id"])


def chapters(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Chapters, each once."""
    cols = ["run_id", "ch_idx", *[c for c in columns if c not in ("run_id", "ch_idx")]]
    return load(spark, d, "pass3_final").select(*cols).dropDuplicates(["run_id", "ch_idx"])


def sightings(spark: SparkSession, d: str) -> DataFrame:
    """(run_id, ch_idx, ev_pos, c_pos, temp_name, descr, anchor_ts): characters
    named in the events of the chapter table, the chapter standing for a chunk."""
    people = F.transform(
        "events",
        lambda e: F.struct(e["start_time"].alias("t"), F.transform(e["characters_in_event"], lambda c: F.when(c.isNotNull(), F.struct(c["name"].alias("n"), c["desc"].alias("d")))).alias("cs")),
    )
    one = load(spark, d, "pass3_final", FINAL_PEOPLE).dropDuplicates(["run_id", "ch_idx"])
    flat = one.select("run_id", "ch_idx", F.posexplode(people).alias("ev_pos", "e")).select("run_id", "ch_idx", "ev_pos", F.col("e.t").alias("anchor_ts"), F.posexplode("e.cs").alias("c_pos", "c"))
    return flat.where(F.col("c").isNotNull()).select("run_id", "ch_idx", "ev_pos", "c_pos", F.col("c.n").alias("temp_name"), F.col("c.d").alias("descr"), "anchor_ts")


def chunk_bounds(e: DataFrame) -> DataFrame:
    """Adds chunk_start and chunk_end in lenient seconds from the range text."""
    from ..functions.timecode import parse_seconds

    p = F.split("chunk_time_range", " - ", -1)
    return e.withColumns({"chunk_start": parse_seconds(F.get(p, F.lit(0))), "chunk_end": parse_seconds(F.get(p, F.lit(1)))})
