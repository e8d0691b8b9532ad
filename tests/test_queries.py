"""Every query against its SQL, and every query without SQL for rows."""

import pytest

import __spark_entry__ as entry
from oracle import connect, difference
from quotewire.plans import registry

FOLDER = "/root/testdata/sf0.001"
# The queries of the llm subpackage have tests of their own.
QUERIES = {n: q for n, q in entry.queries().items() if n in registry.QUERIES}
SQL = {n: s for n, s in entry.oracle_sql().items() if n in registry.QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, con):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(name, spark):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns
    assert not df.isEmpty()


def test_entry(spark):
    assert {r["sentimentType"] for r in entry.entry(spark).collect()} == {
        "Positive", "Negative", "Neutral"
    }


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
