"""Near duplicates against all pairs on small tables."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quotewire.llm import near_dup
from quotewire.llm.queries import QUERIES
from quotewire.llm.words import WordHasher


def brute(rows, idf, similarity=0.8):
    """Class and fate of each (doc_id, text) by all pairs of distinct texts."""
    texts = sorted({t or "" for _, t in rows})
    words, heads = WordHasher().words(pa.array([t.lower() for t in texts], pa.string()))
    bags = [near_dup.shingles(words[a:b], idf) for a, b in zip(heads, heads[1:])]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sure = True
    for i in range(len(texts)):
        for j in range(i):
            s = near_dup._similarity(bags[i], bags[j])
            sure &= abs(s - similarity) > 1e-6
            if s >= similarity:
                parent[root(i)] = root(j)
    of = {t: root(i) for i, t in enumerate(texts)}
    blank = {t for t, bag in zip(texts, bags) if not len(bag[0])}
    least = {}
    for d, t in rows:
        if d is not None:
            least[of[t or ""]] = min(d, least.get(of[t or ""], d))
    return sure, [d if (t or "") in blank else least.get(of[t or ""]) for d, t in rows]


def family(rng, words, n, size, edits):
    base = [rng.choice(words) for _ in range(size)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(size)] = rng.choice(words)
        out.append(" ".join(own))
    return out


def test_all_pairs_are_tried_when_the_best_few_are_tested(spark, monkeypatch):
    """The exact round finds what is left when the first round has no untested pair."""
    cross = near_dup._cross_pairs
    rounds = []

    def only_tested(marked, mixed, held, tries):
        rounds.append(tries)
        found = cross(marked, mixed, held, tries)
        return found if tries is None else found.limit(0)

    monkeypatch.setattr(near_dup, "_cross_pairs", only_tested)
    monkeypatch.setattr(near_dup, "_best_hubs", lambda nodes, bands: spark.createDataFrame([], "a long, b long"))
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(300)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(4)]
    rows.append((9, " ".join(rng.choices(words, k=80))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(df).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 9: 9}
    assert rounds == [near_dup.FIRST_TRIES, None]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_classes_as_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(near_dup, "CHUNK", 16)  # several blocks to a bucket
    monkeypatch.setattr(near_dup, "_PAIRS", 64)  # several turns to a block
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = family(rng, words, 120, 150, 6) + family(rng, words, 60, 300, 20) + family(rng, words, 10, 4, 1)
    texts += family(rng, words, 6, 5000, 40) + [" ".join(rng.choices(words, k=80)) for _ in range(40)]
    texts += texts[:30] + ["Word WORD word"] * 3 + ["word word word"]
    rng.shuffle(texts)
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)]
    rows += [(5000 + i, t) for i, t in enumerate([None, "", "  \n", None, ""])] + [(None, rows[0][1]), rows[1]]
    df = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, keys string")
    idf = near_dup.word_idf(df)
    sure, want = brute(rows, idf)
    assert sure
    got = near_dup.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == Counter(
        (d, c) for (d, _), c in zip(rows, want)
    )
    left = near_dup.drop_near_duplicates(df)
    assert left.columns == df.columns
    blank = [r for r in rows if not (r[1] or "").split()]
    heads = Counter(c for c, (_, t) in zip(want, rows) if (t or "").split())
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(heads.keys()) + Counter(
        d for d, _ in blank
    )


def test_idf_is_bounded_and_falls_with_frequency(spark):
    df = spark.createDataFrame([("the a",), ("the b",), ("the",), (None,)], "text string")
    idf = near_dup.word_idf(df)
    words, _ = WordHasher().words(pa.array(["the a"]))
    the, a = idf[(words >> np.uint64(48)).astype(int)]
    assert 1 <= the < a <= 2


def test_empty_table_and_single_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(empty).count() == 0
    assert near_dup.drop_near_duplicates(empty).count() == 0
    one = spark.createDataFrame([(2, "x"), (1, "X"), (3, "y")], "doc_id int, text string")
    assert {(r["doc_id"], r["class_id"], r["kept"]) for r in near_dup.near_duplicates(one).collect()} == {
        (1, 1, True), (2, 1, False), (3, 3, True)
    }


def test_query_on_the_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    sure, want = brute(rows, near_dup.word_idf(docs))
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op2_near_duplicates"](spark, folder).collect()}
    assert got == {d: c for (d, _), c in zip(rows, want)}
    assert len(set(got.values())) < len(got)
