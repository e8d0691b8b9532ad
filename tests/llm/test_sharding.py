"""The Feistel shuffle: one to one, even, gapless, and the same however rows are stored."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quotewire.llm import sharding
from quotewire.llm.queries import QUERIES


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 24, 1000, 4097])
def test_permutation_is_one_to_one(spark, n):
    places = spark.range(n).select(sharding.permuted(F.col("id"), n, 5).alias("p")).collect()
    assert sorted(r["p"] for r in places) == list(range(n))
    if n >= 1000:
        assert sum(r["p"] == i for i, r in enumerate(places)) < n / 50


def check(rows, n, n_shards):
    assert len(rows) == n
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values(), default=0) - min((sizes[s] for s in range(n_shards)), default=0) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_repeated_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 40)
    rows = [(i, f"text {i}", 1) for i in range(200)] + [(7, "hot", 1)] * 150
    rows += [(None, None, 1)] * 5 + [(None, "", 2), (3, None, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _copies int")
    results = []
    for stored in (df, df.repartition(7)):
        got = sharding.shard(sharding.text_digest(stored), ["doc_id", "size", "text_crc32"], 5).collect()
        check(got, len(rows), 5)
        results.append(Counter(got))
    assert results[0] == results[1]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, _ in rows
    )
    empty = sharding.shard(sharding.text_digest(df.limit(0)), ["doc_id", "size", "text_crc32"])
    assert empty.count() == 0
    with pytest.raises(ValueError, match="slot"):
        sharding.shard(df.withColumnRenamed("_copies", "slot"), ["doc_id", "slot"])


def test_query_on_the_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    df = QUERIES["op6_sharding"](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    rows = df.collect()
    check(rows, spark.read.parquet(f"{folder}/documents.parquet").count(), 24)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
