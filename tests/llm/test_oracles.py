"""The text queries that SQL can express against their oracles, on the smallest tables."""

import pytest

from storyflow.llm import catalog

from ..conftest import SF
from ..helpers import same_as_sql

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0
    same_as_sql(df, oracle, SQL[name])
