"""Every registered query against DuckDB on the supplied tables."""

import pytest

import __spark_entry__ as entry
from duck import assert_same, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_duckdb(spark, connection, name):
    assert_same(entry.queries()[name](spark, FOLDER), entry.oracle_sql()[name], connection)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert {"trip_fingerprint", "fare_rank", "Zone"} <= set(result.columns)
    assert result.count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
