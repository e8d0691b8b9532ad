"""The corpus pipeline: from raw documents to packed training sequences.

Each stage maps documents to documents by one operator of quotewire.llm, the last one to
packed pieces. A stage sees all that its predecessor kept; columns it does not need, and
columns that happen to have the name of one of its own results, pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewire.llm import lang_id, near_dup, packing, substring, toxicity
from quotewire.llm.folds import held_out
from quotewire.llm.queries import word_bpe
from quotewire.llm.words import set_aside
from quotewire.session import bound_text_batches, materialize

#: A language below this probability counts as not recognised.
LEAST_LANGUAGE = 0.5
#: A document from this score on counts as toxic.
LEAST_TOXIC = 0.7


def _bounded(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``stage`` in a session that from then on sends texts to Python in small batches.

    Its result is computed after it returns, so the setting stays.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_text_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


def _filtered(docs: DataFrame, predict, keep) -> DataFrame:
    """``docs`` where ``keep`` holds, judged by columns that ``predict`` adds."""
    docs, restore = set_aside(docs)
    return restore(predict(docs).where(keep).select(*docs.columns))


@_bounded
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: a letter at all, and a probable language.

    Learns from the documents that have a language, as the query of the operator does.
    """
    model = lang_id.train(docs, ~held_out(4, 2))
    return _filtered(
        docs, lambda d: lang_id.predict(d, *model, keep_text=True),
        (F.col("lang_pred") != lang_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE),
    )


@_bounded
def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model of the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, ~held_out(3, 1))
    return _filtered(
        docs, lambda d: toxicity.predict(d, model, keep_text=True),
        F.col("score") < LEAST_TOXIC,
    )


@_bounded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dup.drop_near_duplicates(docs)


@_bounded
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 35 words or more that occur elsewhere too.

    A text that loses nothing stays as it is; of others the words left are joined by one
    space and n_chars follows. A document that loses all its words keeps an empty text.
    """
    docs, restore = set_aside(docs, own=("doc_id", "text", "n_chars"))
    cut = substring.remove_repeats(docs, keep_text=True)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.char_length("kept").cast(kind)
        new["n_chars"] = F.when(changed, length).otherwise(F.col("n_chars"))
    return restore(cut.withColumns(new).select(*docs.columns))


@_bounded
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 4,096, one row per piece of a document."""
    return packing.pack(docs, word_bpe())


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("packing", packed),
]
# Trained models, classes of near duplicates and tokens are beyond SQL; the tests compare
# the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage's result written before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
