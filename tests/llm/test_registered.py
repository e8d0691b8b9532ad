"""The registered queries: all there, and those with SQL against it."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from quotewire.llm import queries as llm

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    df = llm.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = con.execute(llm.ORACLE_SQL[name]).df()[columns].values.tolist()
    got = [list(r) for r in df.select(*columns).collect()]
    assert sorted(got) == sorted(want) and got
