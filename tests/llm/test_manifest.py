"""The Merkle manifest against a tree built leaf by leaf."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quotewire.llm import manifest as m
from quotewire.llm.queries import QUERIES

KIND = "doc_id long, source string, lang string, n_chars long, text string, kids string, n int, hash string, rank long"


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def tree(nodes):
    """Root, and for each node its siblings (left, right) level by level."""
    proofs, spots = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, spot in enumerate(spots):
            run = spot // 16 * 16
            proofs[i].append(("".join(nodes[run:spot]), "".join(nodes[spot + 1 : run + 16])))
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        spots = [s // 16 for s in spots]
    return nodes[0], proofs


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    subroots, inside = [], {}
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, proofs = tree([leaf(r) for r in own])
        subroots.append(root)
        inside[s] = list(zip(own, proofs))
    root, over = tree(subroots)
    out = []
    for s, subroot, above in zip(order, subroots, over):
        for r, proof in inside[s]:
            proof = [*proof, *above]
            hot = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            now = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if hot and r[4] is not None else r[4]
            folded = leaf((*r[:4], now))
            for left, right in proof:
                folded = h(left, folded, right)
            out.append((r[0], leaf(r), subroot, root, h(*[a + b for a, b in proof]), folded, folded == root))
    return Counter(out)


def through_the_query(spark, monkeypatch, df):
    from quotewire.llm import queries

    monkeypatch.setattr(queries, "_table", lambda *_: df)
    out = QUERIES["op13_merkle_manifest"](spark, "")
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r) for r in out.collect())


def some_rows(n, sources, seed=0):
    rng = random.Random(seed)
    return [
        (i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 0, -5, 77]),
         rng.choice([None, "", "Ünïcode", "LOWER me", "lower"]), "k", 1, "h", 1) for i in range(n)
    ]


@pytest.mark.parametrize("digits", [2, 3])
def test_same_as_leaf_by_leaf(spark, monkeypatch, digits):
    monkeypatch.setattr(m, "DIGITS", digits)  # several rollups, one upon the other
    monkeypatch.setattr(m, "BLOCK", 16**digits)
    rows = some_rows(700, [None, "", "a", "a b", "B", "é", "z" * 40, *["hot"] * 12])
    rows += [rows[i][:1] + ("solo%d" % i,) + rows[i][2:] for i in range(20)]
    rows += [(None, "hot", None, None, None, None, None, None, None)] * 3
    rows += [rows[5]] * 40 + [(5, "hot", "en", 1, "another text", "k", 1, "h", 1)] * 2  # repeats, ids that repeat
    df = spark.createDataFrame(rows, KIND)
    want = brute(rows)
    assert through_the_query(spark, monkeypatch, df.repartition(6)) == want
    assert any(not r[6] for r in want) and any(r[6] for r in want)


def test_one_hot_source_of_equal_ids(spark, monkeypatch):
    rows = [(1, "s", "en", 4, "text", "k", 1, "h", 1)] * 5000 + some_rows(100, ["s", "t"])
    assert through_the_query(spark, monkeypatch, spark.createDataFrame(rows, KIND)) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 256, 257])
def test_sizes_at_the_edges(spark, monkeypatch, n):
    rows = some_rows(n, ["s"])
    want = brute(rows) if n else Counter()
    assert through_the_query(spark, monkeypatch, spark.createDataFrame(rows, KIND)) == want


def test_no_join_but_of_ranges_and_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    told = m.manifest(docs, F.lit(False), F.col("text"))
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    # What joins are left number the sources: one row per range and group of the dealt rows.
    assert "ArrowUDF" not in plan and "Python" not in plan
    assert all("_range" in line for line in plan.splitlines() if "Join" in line)
    assert told.where(m.folded(F.col("now"), F.col("proof")) != F.col("root")).count() == 0
    assert told.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof", "now"]
