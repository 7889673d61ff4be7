"""Every core query with SQL against DuckDB, and the others for rows and a stable schema, on the smallest tables."""

import pytest

from quire.queries import CORE_QUERIES, CORE_SQL
from tests.oracle import compare

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CORE_SQL))
def test_against_sql(spark, name):
    assert compare(spark, name, CORE_QUERIES[name], CORE_SQL[name], D) == ""


@pytest.mark.parametrize("name", sorted(set(CORE_QUERIES) - set(CORE_SQL)))
def test_runs(spark, name):
    df = CORE_QUERIES[name](spark, D)
    assert df.count() >= 0 and all(kind != "void" for _, kind in df.dtypes)
