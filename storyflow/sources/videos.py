"""Finding videos: by a directory listing or by a table of paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the extensions of video files.
EXTENSIONS = (".mp4", ".mkv", ".avi", ".mov", ".webm", ".flv")


def extension(path: Column) -> Column:
    """The last extension with its point, '' if there is none."""
    return F.regexp_extract(path, r"\.[^./]*$", 0)


def by_extension(files: DataFrame, path: str = "path", extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """Rows whose path ends in one of the extensions, whatever the case."""
    return files.where(F.lower(extension(F.col(path))).isin(*[e.lower() for e in extensions]))


def discover(spark: SparkSession, path: str, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """(video_id, path, mtime, ext, length) of a directory, recursively, in the
    order of modification. A single file is returned whatever its extension; a
    missing path raises. ``content`` is never read; video_id is a hash of the
    whole path, so that equal file names in different folders stay apart.
    """
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        raise FileNotFoundError(path)
    single = not fs.getFileStatus(hpath).isDirectory()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "modificationTime", "length")
    kept = files if single else by_extension(files, "path", extensions)
    return kept.select(
        F.substring(F.sha2("path", 256), 1, 16).alias("video_id"), "path", F.col("modificationTime").alias("mtime"), F.lower(extension(F.col("path"))).alias("ext"), "length"
    ).orderBy("mtime", "path")
