"""Substring removal against a brute-force count of all windows."""

import hashlib
import random
from collections import Counter

import pytest

from quotewire.llm import substring
from quotewire.llm.queries import QUERIES


def brute(texts, size):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), kept.decode()))
    return out


def corpus(rng, n, alphabet):
    passages = [[rng.choice(alphabet) for _ in range(rng.randint(5, 60))] for _ in range(6)]
    texts = [None, "", " \n\t", "ünï\xa0cödé \x1c x"]
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(passages)[rng.randint(0, 4) :] if rng.random() < 0.6 else [
                rng.choice(alphabet) for _ in range(rng.randint(0, 30))
            ]
        texts.append(rng.choice([" ", "\n", " \t "]).join(words))
    return texts + texts[5:8]


@pytest.mark.parametrize("seed,size,gram,letters", [(1, 35, 8, 40), (2, 9, 4, 12), (3, 6, 6, 3), (4, 5, 1, 2)])
def test_same_as_brute_force(spark, seed, size, gram, letters):
    rng = random.Random(seed)
    texts = corpus(rng, 40, [f"w{i}é" for i in range(letters)])
    df = spark.createDataFrame(
        [(i % 30, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, kept string, spans string"
    ).repartition(4)
    got = substring.remove_repeats(df, size, gram, keep_text=True).collect()
    want = Counter((t, *b) for t, b in zip(texts, brute(texts, size)))
    assert Counter((r["text"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substring.remove_repeats(df).count() == 0


def test_query_on_the_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {
        (d["doc_id"], n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for d, (n, gone, kept) in zip(docs, brute([d["text"] for d in docs], 35))
    }
    got = QUERIES["op7_substring_dedup"](spark, folder).collect()
    assert {(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want
    assert any(w[2] for w in want)
