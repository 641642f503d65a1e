"""Token accounting at several grains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTS = ("prompt_tokens", "completion_tokens", "total_tokens")


def counted(calls: DataFrame) -> DataFrame:
    """Calls that reported any usage; a missing single count is 0."""
    some = calls.where(F.coalesce(*COUNTS).isNotNull())
    return some.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in COUNTS})


def _sums() -> list:
    return [*[F.sum(c).alias(c) for c in COUNTS], F.count(F.lit(1)).alias("calls")]


def by(calls: DataFrame, *keys: str) -> DataFrame:
    """Sums and number of calls for each combination of keys."""
    return counted(calls).groupBy(*keys).agg(*_sums())


def rollup(calls: DataFrame, video: str = "video_id", stage: str = "stage") -> DataFrame:
    """Four grains in one pass: (video, stage), (video), (stage) and overall.
    Keys are counted per video and stage before they are expanded, so the grains
    multiply the groups, not the calls."""
    fine = by(calls, video, stage)
    v, s = F.col(video), F.col(stage)
    return fine.groupingSets([[v, s], [v], [s], []], v, s).agg(*[F.sum(c).alias(c) for c in COUNTS], F.sum("calls").alias("calls"), F.grouping_id().alias("grain"))


def latest(runs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the last by ``order``: a later run replaces an earlier."""
    cols = [c for c in runs.columns if c not in keys]
    g = runs.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])
