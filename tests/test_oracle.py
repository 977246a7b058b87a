"""Every registered query against its SQL on the given tables."""

import pytest
from compare import connect, difference
from conftest import DATA

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0
