"""Stage tables on disk: written once for their inputs, read again after that.

A stage's hash covers its settings and the hashes of the stages before it, so a
changed stage makes every later one run again. A table counts only when its
marker names that hash; the marker is written after the table is complete.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Workspace:
    """Tables of one batch under a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.hashes: dict[str, str] = {}

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def read_text(self, path: str) -> str | None:
        fs, p = self._fs(path)
        if not fs.exists(p):
            return None
        s = fs.open(p)
        try:
            return bytes(b % 256 for b in s.readAllBytes()).decode()
        finally:
            s.close()

    def write_text(self, path: str, text: str) -> None:
        """Write beside and rename, so that no reader sees half a file."""
        fs, p = self._fs(path)
        _, tmp = self._fs(path + ".tmp")
        out = fs.create(tmp, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.delete(p, False)
        fs.rename(tmp, p)

    def remove(self, path: str) -> None:
        """Delete a folder and all in it, if it is there."""
        fs, p = self._fs(path)
        fs.delete(p, True)

    def key(self, name: str, settings: str, after: tuple[str, ...]) -> str:
        text = "|".join([name, settings, *[self.hashes[a] for a in after]])
        self.hashes[name] = hashlib.sha256(text.encode()).hexdigest()[:24]
        return self.hashes[name]

    def begin(self, folder: str, stage: str) -> None:
        """Remove a stage's rounds unless they are of the stage's own inputs."""
        want, mark = self.hashes.get(stage, ""), f"{self.root}/{folder}/_inputs"
        if self.read_text(mark) != want:
            self.remove(f"{self.root}/{folder}")
            self.write_text(mark, want)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.table(name)

    def stage(self, name: str, settings: str, after: tuple[str, ...], build: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table, built only if it is not there for these inputs."""
        want, mark = self.key(name, settings, after), f"{self.root}/_marks/{name}"
        if self.read_text(mark) != want:
            self.put(name, build())
            self.write_text(mark, want)
        return self.table(name)
