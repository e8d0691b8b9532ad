"""Compare queries with their SQL in DuckDB.

As a script: ``python tests/oracle.py [data folder] [query ...]``.
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(frame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted((tuple(r) for r in frame.itertuples(index=False)), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark frame and a query, or None."""
    ours, theirs = df.toPandas(), con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} vs {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    if len(ours) == 0:
        return "no rows"
    a, b = _rows(ours), _rows(theirs)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, e.g. {wrong[0][0]} vs {wrong[0][1]}"[:600]
    kinds = [
        (c, str(ours[c].dtype), str(theirs[c].dtype))
        for c in sorted(ours.columns) if ours[c].dtype.kind != theirs[c].dtype.kind
        and not (ours[c].isna().any() or theirs[c].isna().any())
    ]
    return f"types differ: {kinds}" if kinds else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from quotewire.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                              "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(folder), entry.oracle_sql(), []
    wanted = sys.argv[2:] or list(entry.queries())
    for name in wanted:
        start = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            problem = difference(df, con, oracle[name]) if name in oracle else None
            note = problem or ("ok" if name in oracle else f"{df.count()} rows (no SQL)")
        except Exception as error:  # report every failing query, then go on
            problem = note = f"{type(error).__name__}: {str(error)[:700]}"
        if problem:
            bad.append(name)
        print(f"{name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{len(wanted) - len(bad)} of {len(wanted)} good; bad: {bad}")
    sys.exit(bool(bad))
