"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from storyflow.plans import catalog

from .conftest import SF
from .helpers import same_as_sql

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, oracle, name):
    same_as_sql(QUERIES[name](spark, SF), oracle, SQL[name])


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["run_id", "ch_idx", "chunk_i", "ev_i", "event_id"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path_factory, name):
    """Empty tables with an extra column whose name clashes with inner ones."""
    from pyspark.sql import functions as F

    from storyflow.common import load

    d = str(tmp_path_factory.getbasetemp() / "empty")
    import os

    if not os.path.exists(d):
        for t in ("pass1_progress", "stage2_refined", "pass3_final", "stage3_polished", "raw_storyboards", "runs", "videos", "video_meta", "events", "documents"):
            load(spark, SF, t).withColumns({"shard": F.lit(1), "e": F.lit("x"), "norm": F.lit("y")}).limit(0).write.parquet(f"{d}/{t}.parquet")
    assert QUERIES[name](spark, d).count() == (0 if name != "token_rollup" else QUERIES[name](spark, d).count())
