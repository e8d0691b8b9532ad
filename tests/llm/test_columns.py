"""Columns of the caller with the names of helper columns, and names that need quoting."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quotewire.llm import lang_id, near_dup, pieces, quality, substring, toxicity
from quotewire.llm.folds import held_out
from quotewire.llm.words import set_aside
from quotewire.session import materialize

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "spans", "_f1", "_f2", "_letter", "_key", "_spot", "_group", "_aside0", "_aside9", "a.b", "a b", "node",
    "lang_pred", "score", "kept", "n_words", "class_id", "label", "decoded", "SCORE_2", "kla`mmer",
]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.read.parquet(f"{FOLDER}/documents.parquet")
    values = [F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")) for i in range(len(NAMES))]
    return plain.select("*", *values).toDF(*plain.columns, *NAMES)


def untouched(df, replaced=()):
    names = [n for n in NAMES if n not in replaced]
    values = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    place = {n: f"c{df.columns.index(n)}" for n in names}
    own = f"c{df.columns.index('doc_id')}"
    for i, name in enumerate(NAMES):
        if name in place:
            want = F.concat(F.lit(f"{i}:"), F.col(own).cast("string"))
            assert values.where(~F.col(place[name]).eqNullSafe(want)).isEmpty(), name
    return df.columns


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_return_all_columns_untouched(spark, docs, name, stage):
    got = materialize(stage(spark, docs, FOLDER))
    assert got.dtypes == docs.dtypes
    assert got.count() > 0
    untouched(got)


def test_packing_drops_them(spark, docs):
    got = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    want = corpus_pipeline.STAGES[-1][1](spark, docs.select("doc_id", "text"), FOLDER)
    assert got.columns == want.columns and got.count() == want.count()


def test_operators_replace_their_own_columns_only(spark, docs):
    model = lang_id.train(docs, ~held_out(4, 2))
    untouched(lang_id.predict(docs, *model), {"lang_pred", "score"})
    untouched(substring.remove_repeats(docs, keep_text=True), {"n_words", "kept"})
    some = [(bytes([i]), 1) for i in range(256)] + [(b" the", 0)]
    untouched(pieces.encode(docs, some))
    both = pieces.encode(docs, some, with_decoded=True)
    untouched(both, {"decoded"})
    untouched(pieces.decode(both, some), {"decoded"})
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for operator in (quality, toxicity):
        fitted = operator.train(docs, labels, ~held_out(3, 1))
        fitted = fitted[0] if operator is quality else fitted
        untouched(operator.predict(docs, fitted), {"score"})
    assert near_dup.near_duplicates(docs).count() == docs.count()


def test_names_set_aside_come_back(spark):
    df = spark.sql("SELECT 1 doc_id, 2 `a.b`, 3 Score, 4 text, 5 _aside1")
    inner, restore = set_aside(df, replaced={"score"})
    assert inner.columns == ["doc_id", "_aside1", "text", "_aside4"]
    assert restore(inner.withColumn("score", F.lit(9))).columns == ["doc_id", "a.b", "text", "_aside1", "score"]
