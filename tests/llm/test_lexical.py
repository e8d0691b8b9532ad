"""The reversed search against a plain scoring of every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from quotewire.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS, ITEMS = "score string, doc_id long, text string, rank int", "item_id long, text string, score string"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, k):
    counts = [(doc_id, Counter(terms(text))) for _, doc_id, text, _ in docs]
    holders = Counter(t for _, c in counts for t in c)
    n_docs, total = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    asked = {}
    for item, text in sorted({(i, t) for i, t, _ in items}, key=repr):
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, own in asked.items():
        scored = []
        for doc_id, c in counts:
            m = 25 + 75 * sum(c.values()) * n_docs // total if total else 0
            score = sum(
                n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, n in own.items() if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, doc_id, -score))
    return sorted(out, key=repr)


def case(seed):
    rng = random.Random(seed)
    words = ["the", "The", "x-y", "été", "ÉTÉ", "日本", "a_b", "don't", "1st", "zeta", "nul\x00l", "ﬁ"]
    words += [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [("s", i, text(rng.randrange(1, 60)), 1) for i in range(300)]
    docs += [("s", 1000 + i, docs[3][2], 1) for i in range(200)]  # a hot text: ties by doc_id
    docs += [("s", None, docs[5][2], 1), ("s", 5, docs[5][2], 1), ("s", 2000, None, 1), ("s", 2001, "", None),
             ("s", 2002, " .,;\n", 1), ("s", 2003, text(20_000), 1), ("s", 2004, "q" * 300_000 + " zeta", 1)]
    items = [(i, text(rng.randrange(1, 30)), "s") for i in range(40)]
    items += [(7, "zeta other", "s"), items[3], (None, "été 日本", "s"), (50, None, "s"), (51, "", "s"),
              (52, "nowhere", "s"), (53, "w1 w1 W1", "s")]
    return docs, items


@pytest.mark.parametrize("block", [None, 60])
def test_same_as_scoring_every_document(spark, monkeypatch, block):
    if block:  # several indexes, windows within a text, parts of a score table
        monkeypatch.setattr(lexical, "INDEX_PLACES", block)
        monkeypatch.setattr(lexical, "_WINDOW", 500)
        monkeypatch.setattr(lexical, "_CELLS", 300)
    docs, items = case(1)
    found = lexical.search(
        spark.createDataFrame(docs, DOCS).repartition(7), spark.createDataFrame(items, ITEMS), 10
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == brute(docs, items, 10) and len(got) > 300


def test_few_documents_and_empty_tables(spark):
    docs, items = spark.createDataFrame(case(2)[0][:3], DOCS), spark.createDataFrame(case(2)[1], ITEMS)
    got = sorted((tuple(r) for r in lexical.search(docs, items, 10).collect()), key=repr)
    assert got == brute(case(2)[0][:3], case(2)[1], 10)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.selectExpr("doc_id", "'' text"), items)):
        assert lexical.search(d, i).collect() == []


def test_heaps_hold_k_entries():
    import numpy as np
    import pyarrow as pa

    heaps = lexical.Heaps(2, 3)
    for start in range(0, 1000, 100):
        ids = pa.array(range(start, start + 100), pa.int64())
        heaps.update(np.stack([np.arange(100), np.zeros(100, np.int64)], axis=1), ids)
        assert all(len(h) <= 3 for h in heaps.heaps)
    assert sorted(zip(*heaps.rows())) == [(0, 99, 99), (0, 199, 99), (0, 299, 99)]
