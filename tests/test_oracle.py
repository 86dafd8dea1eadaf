"""Every catalog query against its DuckDB oracle on the smallest test tables
(the driver runs the same comparison at sf0.01)."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

SF = os.environ.get("CELLCAST_TEST_SF", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], SQL[name], SF, con)
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 3
    assert set(df.columns) >= {"risk_group", "capture_rate"}
