"""The pipeline's stages, each against what its predecessor kept."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quotewire.llm import lang_id, near_dup, toxicity
from quotewire.llm.folds import held_out
from quotewire.llm.queries import word_bpe
from quotewire.session import TEXT_BATCHES, materialize
from test_near_dup import brute as brute_classes
from test_packing import check as check_packing
from test_substring import brute as brute_repeats

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER))
        out.append(docs)
    return out


def test_documents_keep_their_columns(results):
    for df in results[1:-1]:
        assert df.dtypes == results[0].dtypes


def test_stages_send_texts_to_python_in_small_batches(spark, results):
    assert {name: spark.conf.get(name) for name in TEXT_BATCHES} == TEXT_BATCHES


def test_language_stage(results):
    docs, kept = results[:2]
    found = lang_id.predict(docs, *lang_id.train(docs, ~held_out(4, 2))).where("lang_pred <> 'und' AND score >= 0.5")
    assert {r["doc_id"] for r in found.collect()} == {r["doc_id"] for r in kept.collect()}
    assert kept.count() > 0.99 * docs.count()


def test_toxicity_stage(spark, results):
    docs, kept = results[1:3]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.train(docs, labels, ~held_out(3, 1))
    found = toxicity.predict(docs, model).where("score < 0.7")
    assert {r["doc_id"] for r in found.collect()} == {r["doc_id"] for r in kept.collect()}
    clean = docs.join(labels.where("toxic = 0"), "doc_id", "left_semi")
    assert clean.join(kept, "doc_id", "left_anti").count() <= 0.02 * clean.count()


def test_near_duplicate_stage(results):
    docs, kept = results[2:4]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sure, classes = brute_classes(rows, near_dup.word_idf(docs))
    assert sure and {r["doc_id"] for r in kept.collect()} == set(classes)


def test_substring_stage(results):
    docs, kept = results[3:5]
    rows = docs.collect()
    after = {r["doc_id"]: r for r in kept.collect()}
    assert len(after) == len(rows)
    lost = 0
    for row, (_, gone, text) in zip(rows, brute_repeats([r["text"] for r in rows], 35)):
        new = after[row["doc_id"]]
        assert new["text"] == (text if gone else row["text"])
        assert new["n_chars"] == (len(text) if gone else row["n_chars"])
        lost += gone
    assert lost > 0


def test_packing_stage(spark, results):
    docs = [(r["doc_id"], r["text"]) for r in results[4].collect()]
    check_packing(results[5].collect(), docs, Tokenizer.from_str(word_bpe()), 4096)


def test_odd_rows_pass(spark):
    rng = random.Random(1)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    text = " ".join(rng.choices(words, k=200))
    rows = [(i, " ".join(rng.choices(words, k=60)), "en", "s", 0, "a", 1.5, "k") for i in range(30)]
    rows += [(100, None, "en", "s", 0, "a", 1.5, "k"), (101, "", None, "s", 0, "a", 1.5, "k"), (102, "123 %", "en", None, None, "a", 1.5, "k"),
             (None, text, "en", "s", 0, "a", 1.5, "k"), (104, text, "en", "s", 0, "a", 1.5, "k"), (104, text, "en", "s", 0, "a", 1.5, "k")]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, score double, kept string"
    )
    docs = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, FOLDER))
        assert docs.dtypes == df.dtypes
        assert docs.where("lang_pred = 'a' AND score = 1.5 AND kept = 'k'").count() == docs.count()
    assert Counter(r["doc_id"] for r in docs.collect()) == Counter([*range(30), 104])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r["doc_id"] for r in packed.collect()} == {*range(30), 104}


def test_empty_table_passes(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER))
        assert docs.count() == 0


def test_run_is_the_last_stage(spark, results):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, FOLDER).select(*columns)
    want = results[-1].select(*columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
