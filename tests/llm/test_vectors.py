"""Vector operators against all pairs."""

import numpy as np
import pytest

from quotewire.llm import topk, vector_dup
from quotewire.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>, label int, node string"


def brute_links(rows, similarity=0.98):
    unit = []
    for _, v, label, *_ in rows:
        ok = label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)
        a = np.array(v, np.float32).astype(float) if ok else None
        unit.append(a / np.sqrt((a * a).sum()) if ok and a.any() else None)
    n, links, parent = len(rows), [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b >= similarity:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(r[0], least.get(root(i), r[0]))
    return [(r[0], links[i], least.get(root(i))) for i, r in enumerate(rows)]


def some_vectors(rng, n, dim):
    base = rng.standard_normal((n, dim))
    near = base[rng.integers(0, n // 8, n)] + 0.06 * rng.standard_normal((n, dim))
    return np.vstack([base, near]).astype(np.float32)


def test_links_same_as_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vector_dup, "CHUNK", 8)
    rng = np.random.default_rng(1)
    vectors = some_vectors(rng, 160, 16)
    rows = [(i, v.tolist(), int(i % 3 == 0), "n") for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[5][1], rows[5][2], "n") for i in range(20)]  # a group of copies
    rows += [(2000, (3e30 * vectors[5]).tolist(), rows[5][2], "n"), (2001, (1e-30 * vectors[5]).tolist(), rows[5][2], "n")]
    nan, inf = float("nan"), float("inf")
    rows += [(3000, None, 1, "n"), (3001, [], 1, "n"), (3002, [0.0] * 16, 1, "n"), (3003, [0.0] * 16, 1, "n"),
             (3004, [nan] * 16, 1, "n"), (3005, [inf, *[0.0] * 15], 1, "n"), (3006, [None, *[1.0] * 15], 1, "n"),
             (3007, rows[4][1], None, "n"), (3008, rows[4][1], None, "n"), (3009, rows[4][1], None, "n"),
             (3010, [1.0, 2.0], 1, "n"), (3011, [1.0, 2.0], 1, "n"), (None, rows[4][1], rows[4][2], "n"), rows[4]]
    got = vector_dup.near_duplicate_vectors(spark.createDataFrame(rows, KIND).repartition(3)).collect()
    assert sorted([tuple(r)[:3] for r in got], key=str) == sorted(brute_links(rows), key=str)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    empty = spark.createDataFrame([], KIND)
    assert vector_dup.near_duplicate_vectors(empty).count() == 0


def test_recall_just_above_the_threshold(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((500, 64))
    near = base[:400] + 0.17 * rng.standard_normal((400, 64))  # cosines about 0.986
    rows = [(i, v.tolist(), 0, "n") for i, v in enumerate(np.vstack([base, near]).astype(np.float32))]
    want = {i: n for i, n, _ in brute_links(rows)}
    got = vector_dup.near_duplicate_vectors(spark.createDataFrame(rows, KIND)).collect()
    assert all(r["n_links"] <= want[r["vec_id"]] for r in got)
    assert sum(r["n_links"] for r in got) >= 0.95 * sum(want.values()) > 500


def test_query_on_the_given_embeddings(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = QUERIES["op5_vector_duplicates"](spark, folder).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(brute_links(rows))


def brute_top(rows, is_query, k, scale=256):
    good = [(r[0], [int(np.floor(float(np.float32(x)) * scale)) for x in r[1]]) for r in rows if r[0] is not None and r[1]
            is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    out = []
    for q, v in {q: v for q, v in good if is_query(q)}.items():
        best = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in good if c != q and len(w) == len(v))[:k]
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("scale", [256, 4])
def test_top_k_same_as_all_pairs(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 15)
    monkeypatch.setattr(topk, "LEAF", 8)
    rng = np.random.default_rng(2)
    vectors = some_vectors(rng, 120, 6)
    rows = [(i, v.tolist(), 0, "n") for i, v in enumerate(vectors)]
    rows += [(500 + i, rows[3][1], 0, "n") for i in range(30)]
    rows += [(600, None, 0, "n"), (605, [None] * 6, 0, "n"), (610, [float("nan")] * 6, 0, "n"), (615, [0.0] * 6, 0, "n"),
             (620, [1.0, 2.0], 0, "n"), (621, [2.0, 1.0], 0, "n"), (625, [], 0, "n"), (None, rows[0][1], 0, "n"), rows[7]]
    df = spark.createDataFrame(rows, KIND)
    from pyspark.sql import functions as F

    got = topk.top_k(df, F.col("vec_id") % 5 == 0, 4, scale).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, lambda q: q % 5 == 0, 4, scale)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_huge_entries_stay_exact():
    rng = np.random.default_rng(3)
    points = np.floor(rng.standard_normal((200, 4)) * 2.0**28)
    points[100:120] = points[3]
    ids = np.arange(200)
    q, name, score = topk.search(points, ids, points[:9], ids[:9], np.full(9, -np.inf), 5)
    rows = [(int(i), [int(x) for x in p]) for i, p in zip(ids, points)]
    want = []
    for i in range(9):
        best = sorted((-sum(a * b for a, b in zip(rows[i][1], w)), c) for c, w in rows if c != i)[:5]
        want += [(i, c, -s) for s, c in best]
    assert sorted(zip(q.tolist(), name.tolist(), score.tolist())) == sorted(want)
