"""Sampled segmentations: exact probabilities, the same every time, and lossless."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from quotewire.llm import pieces
from quotewire.llm.queries import QUERIES

SMALL = [(b"<unk>", 2), *[(bytes([i]), 1) for i in range(256)],
         *[(p.encode(), 0) for p in (" a", "ab", "abc", "b", "c", "bc", "a", " ", "  ", " ab", "é", "cab")]]


def ways(word, weights, low):
    """All segmentations of a word with their weights."""
    if not word:
        return [((), 1.0)]
    out = []
    for n in range(1, len(word) + 1):
        head = word[:n]
        options = [(i, w) for name, i, w in weights if name == head]
        if n == 1:
            options.append((1 + head[0], low))
        out += [((i, *rest), w * v) for i, w in options for rest, v in ways(word[n:], weights, low)]
    return out


def test_samples_have_the_lattices_probabilities():
    names = [n for n, kind in SMALL if kind == 0]
    weights = [(n, 257 + r, 1 / (r + 2)) for r, n in enumerate(names)]
    low = (len(SMALL) + 2) ** -2.0
    lattices = pieces._Lattices(SMALL, 1.0)
    for word in (b" abc", b"  abcab", "éa".encode(), b"zb"):
        every = ways(word, weights, low)
        total = sum(w for _, w in every)
        index = lattices.words[word]
        if index >= len(lattices.length):
            lattices.learn([word])
        n = 40_000
        found, counts = lattices.sample(np.full(n, index), pieces.mix(np.arange(n).astype(np.uint64)))
        seen = Counter(tuple(x.tolist()) for x in np.split(found, np.cumsum(counts)[:-1]))
        assert set(seen) <= {s for s, _ in every}
        for s, w in every:
            p = w / total
            assert abs(seen[s] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 2 / n


def exact_shares(word, pieces_, sharpness=1.0):
    """For all edges (start, piece) of a word's lattice the share of segmentations using it."""
    names = {n: (i, 1 / (r + 2)) for r, (i, n) in enumerate(
        (i, n) for i, (n, kind) in enumerate(pieces_) if kind == 0)}
    low, longest = (len(pieces_) + 2) ** -2.0, max(map(len, names))
    edges = []
    for a in range(len(word)):
        edges.append((a, a + 1, 1 + word[a], low))
        edges += [(a, b, *names[word[a:b]]) for b in range(a + 1, min(a + longest, len(word)) + 1)
                  if word[a:b] in names]
    ahead, back = ([-math.inf] * (len(word) + 1) for _ in range(2))
    ahead[0] = back[-1] = 0.0
    for a, b, _, w in edges:
        ahead[b] = np.logaddexp(ahead[b], ahead[a] + math.log(w))
    for a, b, _, w in reversed(edges):
        back[a] = np.logaddexp(back[a], back[b] + math.log(w))
    return {(a, i): math.exp(ahead[a] + math.log(w) + back[b] - ahead[-1]) for a, b, i, w in edges}


WIDE = [*SMALL, *[(p.encode(), 0) for p in ("你好", "你", "好", "你好你", "好你", "世", "好世", "xx", "xxx", "x")]]


@pytest.mark.parametrize("text", [
    "你好" * 50, "你好世你" * 30, "x" * 300, " " * 150 + "ab", "a" + "abc" * 60 + "zé" * 40 + "ab" * 40,
])
def test_long_runs_have_the_whole_lattices_probabilities(spark, text):
    """Also across every 64th byte, and inside of lattices that no place parts."""
    n, word = 3000, b" " + text.encode()
    sizes = np.array([len(name) for name, _ in WIDE])
    df = spark.createDataFrame([(i, text) for i in range(n)], "doc_id long, text string")
    seen = Counter()
    for row in pieces.encode(df, WIDE).collect():
        ids = np.array(row["ids"])
        ends = np.cumsum(sizes[ids])
        assert ends[-1] == len(word)
        seen.update(zip((ends - sizes[ids]).tolist(), ids.tolist()))
    exact = exact_shares(word, WIDE)
    assert set(seen) <= set(exact)
    for edge, p in exact.items():
        assert abs(seen[edge] / n - p) < 6 * math.sqrt(max(p * (1 - p), 0) / n) + 3 / n, edge


def test_long_runs_of_the_given_model(spark, model):
    """A character that the model has comes as bytes only by rare chance, wherever it stands."""
    text = "的人是在有" * 60
    assert all(any(c.encode() == name for name, kind in model if kind == 0) for c in set(text))
    single = np.array([kind == 1 for _, kind in model])
    df = spark.createDataFrame([(i, text) for i in range(50)], "doc_id long, text string")
    rows = pieces.encode(df, model).collect()
    assert sum(single[r["ids"]].sum() for r in rows) < 50


def test_long_lattices_are_not_kept():
    lattices = pieces._Lattices(WIDE, 1.0)
    assert lattices.parts([b"zabcz" * 30, b"x" * 200]) == [[b"z", b"abc", b"z"] * 30, [b"x" * 200]]
    lattices.learn([w for w in (b"ab",) if lattices.words[w] == 0])
    kept = lattices.tables()
    lattices.learn([w for w in (b"x" * 200,) if lattices.words[w] == 1])
    lattices.forget(kept)
    assert list(lattices.words) == [b"ab"] and len(lattices.length) == 1


def odd_texts():
    rng = random.Random(1)
    letters = list("ab cé\n  ▁\x00\t你\U0001F600") + ["the ", " of", "   "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(150)]
    return [*texts, None, "", " ", "\n", "x" * 5000, " " * 700, "é" * 3000, "▁", "<0x41>", "</s>"]


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def test_round_trip_and_repeatability(spark, model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 40)
    texts = odd_texts()
    rows = [(i if i % 9 else None, t, "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], "x", "y")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    got = pieces.decode(pieces.encode(df, model, keep_text=True), model).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(r[:2] for r in rows)
    assert all(r["decoded"] == r["text"] for r in got)
    by_row = {}
    for r in got:
        assert by_row.setdefault((r["doc_id"], r["text"]), r["ids"]) == r["ids"]
    again = pieces.encode(df.repartition(5), model, keep_text=True).collect()
    assert all(by_row[(r["doc_id"], r["text"])] == r["ids"] for r in again)
    other = pieces.encode(df, model, seed=1, keep_text=True).collect()
    assert any(by_row[(r["doc_id"], r["text"])] != r["ids"] for r in other)
    assert pieces.encode(df.limit(0), model).count() == 0


def test_likely_pieces_come_often(spark, model):
    """Samples hover about as many pieces as the model's own segmentation, not about bytes."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = "the people of the country came together for the first time in years " * 20
    df = spark.createDataFrame([(i, text) for i in range(20)], "doc_id long, text string")
    sizes = [len(r["ids"]) for r in pieces.encode(df, model).collect()]
    assert len(set(sizes)) > 1 and 1 <= np.mean(sizes) / len(own.encode(text)) < 2


def test_query_on_the_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op9_pieces"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["lossless"] and r["n_ids"] == len(r["ids"]) > 0 for r in rows)


def test_runs_same_as_by_pattern():
    import re

    cut, rng = re.compile(rb" *[^ \n]+|\n| +").findall, random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice(" \nabé\t") for _ in range(rng.randrange(12))).encode()
        assert pieces._runs(text, cut) == cut(b" " + text)


def test_decoding_in_the_same_pass(spark):
    texts = [(1, "ab c\n\nabc  b"), (2, ""), (3, None), (4, "é\n"), (4, " x" * 400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    both = pieces.encode(docs, SMALL, with_decoded=True, keep_text=True).collect()
    assert all(r["decoded"] == r["text"] for r in both) and len(both) == 5
    apart = pieces.decode(pieces.encode(docs, SMALL), SMALL)
    assert sorted(map(repr, apart.collect())) == sorted(repr(r) for r in pieces.encode(docs, SMALL, with_decoded=True).collect())


def test_words_are_forgotten_without_changing_samples():
    rng = random.Random(3)
    lattices, fresh = pieces._Lattices(SMALL, 1.0), pieces._Lattices(SMALL, 1.0)
    words = ["".join(rng.choices("abcé", k=rng.randint(1, 9))).encode() for _ in range(200)]
    words = list(dict.fromkeys(words))
    for w in words:
        lattices.words[w]
    lattices.learn(words)
    kept = words[1::3]
    lattices.again[1::3] = True
    lattices.keep_common(len(words))
    assert list(lattices.words) == kept
    more = [w + b"zab" for w in kept[:9]]
    for w in more:
        lattices.words[w]
    lattices.learn(more)
    for w in [*kept, *more]:
        fresh.words[w]
    fresh.learn([*kept, *more])
    index = np.arange(len(kept) + len(more))
    keys = pieces.mix(index.astype(np.uint64))
    for got, want in zip(lattices.sample(index, keys), fresh.sample(index, keys)):
        assert np.array_equal(got, want)
    lattices.keep_common(0)
    assert not lattices.words and not len(lattices.share)
