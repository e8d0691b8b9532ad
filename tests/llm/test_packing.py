"""Packing: ids as the tokenizer gives them, each in one piece, bins by plain first fit."""

import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quotewire.llm import packing
from quotewire.llm.queries import QUERIES, word_bpe
from quotewire.session import TEXT_BATCHES


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(word_bpe())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, docs, tokenizer, length):
    """docs: list of (doc_id, text); rows of one document follow each other by start."""
    pieces, want = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for key, text in docs:
        ids = np.array(ids_of(tokenizer, text), "<u4")
        for at in range(0, len(ids), length):
            part = ids[at : at + length]
            want[key].append((at, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= length
    return bins


def test_word_ids_are_the_tokenizers(tokenizer):
    rng, encoder = random.Random(1), packing._WordIds(word_bpe())
    assert encoder.pattern
    letters = list("ab'sTt  \n\x1c\xa0é́Σσς#%<|>3٣ǅ你\U0001F600İ") + [
        "<|endoftext|>", "<|startoftext|>", "'ve", "'LL", *map(chr, range(0x21, 0x300, 3))
    ]
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        ids, counts = encoder.encode([text.encode(), None, text.encode()])
        want = ids_of(tokenizer, text)[:-1]
        assert ids.tolist() == want + want and counts.tolist() == [len(want), 0, len(want)]


def test_first_fit_decreasing_is_first_fit():
    rng = random.Random(2)
    for _ in range(60):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(0, 70))]
        room, want = [], [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            spot = next((b for b, left in enumerate(room) if left >= sizes[i]), len(room))
            room[spot:spot + 1] = [(room[spot] if spot < len(room) else 50) - sizes[i]]
            want[i] = spot
        assert packing.first_fit_decreasing(sizes, 50) == want


def test_odd_rows(spark, monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    rng = random.Random(3)
    words = [f"word{i}" for i in range(200)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(80)]
    docs += [(None, None), (None, "x"), (7, ""), (7, "same"), (7, "same"), (900, "long " * 3000)]
    df = spark.createDataFrame([(d, t, "s") for d, t in docs], "doc_id long, text string, _spot string")
    rows = packing.pack(df.repartition(3), word_bpe(), length=64, group_pieces=50).collect()
    bins = check(rows, docs, tokenizer, 64)
    assert len({s >> 32 for s in bins}) > 1
    assert packing.pack(df.limit(0), word_bpe()).count() == 0


def test_query_on_the_given_documents(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = QUERIES["op8_packing"](spark, folder).collect()
    bins = check(rows, [(d["doc_id"], d["text"]) for d in docs], tokenizer, 4096)
    tokens = sum(r["length"] for r in rows)
    assert len(bins) <= tokens / 4096 * 1.01 + 1


def test_words_are_forgotten_without_changing_ids(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    rng, tokenizer = random.Random(7), Tokenizer.from_str(word_bpe())
    encoder = packing._WordIds(word_bpe())
    for _ in range(12):
        texts = [" ".join(f"{rng.choice('abcé')}{rng.randint(0, 90)}İx"[: rng.randint(1, 4)] for _ in range(20)) for _ in range(5)]
        ids, counts = encoder.encode([*[t.encode() for t in texts], None])
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for own in want for i in own] and counts.tolist() == [*map(len, want), 0]
        assert len(encoder.hashes) < 50 + 100


def test_plain_characters_are_normalised_as_by_the_tokenizer():
    encoder = packing._WordIds(word_bpe())
    plain = [chr(i) for i in range(0x300) if encoder.PLAIN.fullmatch(chr(i))]
    text = " ".join(x + y for x in plain[::7] for y in plain)
    assert encoder.normal is str.lower
    assert encoder.normal(text) == encoder.tokenizer.normalizer.normalize_str(text)


def test_a_task_holds_little_besides_its_batch(spark, monkeypatch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema: task)
    task, rng = packing.pieces(docs, word_bpe()), random.Random(8)
    words = [f"{rng.choice('abcd')}word{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(words, k=2000)) for _ in range(500)]  # 9 MB
    keys = pa.array(range(len(texts)), pa.int64())
    batch = pa.record_batch([keys, keys, pa.array(texts)], names=["doc_id", "_key", "text"])
    tracemalloc.start()
    rows = sum(out.num_rows for out in task(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows >= len(texts) and peak < 64e6


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    (name, value), = TEXT_BATCHES.items()
    before, within, written = spark.conf.get(name), [], packing.materialize
    spark.conf.set(name, "32m")
    monkeypatch.setattr(packing, "materialize", lambda df: within.append(spark.conf.get(name)) or written(df))
    try:
        packing.pack(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), word_bpe())
        assert within == [value] and spark.conf.get(name) == "32m"
    finally:
        spark.conf.set(name, before)
