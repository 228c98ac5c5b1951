"""Every registered query with SQL against its DuckDB oracle at sf0.001 (rows, columns, values)."""

import os

import pytest

import __spark_entry__ as E
from tests.compare import compare, duck_connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("key", sorted(E.queries().keys() & E.oracle_sql().keys()))
def test_query_matches_oracle(spark, duck, key):
    r = compare(spark, duck, key, E.queries()[key], E.oracle_sql().get(key), SF)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "pix_adoption_rate_pct" in df.columns
