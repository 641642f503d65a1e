"""All registered queries of the core with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..common import shipped
from . import narrative, people, timing, training

_MODULES = (training, timing, people, narrative)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: shipped(f) for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in getattr(m, "SQL", {}).items()}
