"""Helpers shared by all modules: table access, checkpoints, session defaults."""

from __future__ import annotations

import functools
import io
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make sure that Python workers can import this package.

    Where its folder is on PYTHONPATH there is nothing to do; else a zip of its
    sources goes to the executors once for each application, through Spark's own
    file server.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    on_path = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    app = spark.sparkContext.applicationId
    if root in on_path or app in _SHIPPED:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(os.path.join(root, "storyflow")):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    path = os.path.join(tempfile.mkdtemp(prefix="storyflow-"), "storyflow.zip")
    with open(path, "wb") as out:
        out.write(data.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query that ships the package before it plans anything."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def load(spark: SparkSession, sf_dir: str, table: str, schema: str | None = None) -> DataFrame:
    """Read one table of a data directory; with ``schema`` only the columns and
    members it names. Members of nested lists are pruned from the scan only when
    they are named like this: two levels of unnesting hide them from the planner.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{sf_dir}/{table}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names. Where none is named a folder of
    this machine is set on a local master only; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "storyflow-checkpoints"))


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    The files live in the shared checkpoint folder, so a lost executor costs a
    re-read and never a wrong or missing row.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def build_session(app: str = "storyflow", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session with the settings the queries are tested under."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
