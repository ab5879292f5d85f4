"""Every registered query runs; where SQL can say it, DuckDB gives the same rows."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == ""
    else:
        assert df.count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 15
