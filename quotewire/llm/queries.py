"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewire.llm import (
    lang_id,
    lexical,
    manifest,
    near_dup,
    oracles,
    packing,
    pieces,
    quality,
    sharding,
    substring,
    topk,
    toxicity,
    url_filter,
    vector_dup,
)
from quotewire.llm.folds import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_bpe() -> str:
    """The definition of the public word-level BPE, read on the driver."""
    import public_tokenizers  # here, so that the other queries do without it

    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select(
        "doc_id", held_out(4, 2).alias("held_out"), "lang", "text"
    )
    model = lang_id.train(docs, ~F.col("held_out"))
    return lang_id.predict(docs.drop("lang"), *model)


@query
def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return near_dup.near_duplicates(docs).select("doc_id", "class_id", "n_copies", "kept")


def _scored(spark: SparkSession, folder: str, modulus: int, remainder: int, model, least: float) -> DataFrame:
    docs = _table(spark, folder, "documents").select(
        "doc_id", held_out(modulus, remainder).alias("held_out"), "text"
    )
    trained = model.train(docs, _table(spark, folder, "labels"), ~F.col("held_out"))
    trained = trained[0] if model is quality else trained
    return model.predict(docs, trained).withColumn("predicted", (F.col("score") >= least).cast("int"))


@query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, 5, 0, quality, 0.3)


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, 3, 1, toxicity, 0.7)


@query
def op5_vector_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dup.near_duplicate_vectors(_table(spark, folder, "embeddings"))


@query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["doc_id", "size", "text_crc32"]
    placed = sharding.shard(sharding.text_digest(_table(spark, folder, "documents")), columns)
    return placed.select(
        *columns, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), word_bpe())


@query
def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = _table(spark, folder, "documents").select("doc_id", "text", F.crc32("text").alias("text_crc32"))
    decoded = pieces.encode(docs, model, with_decoded=True)
    return decoded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_ids"),
        F.crc32("decoded").alias("decoded_crc32"),
        F.crc32("decoded").eqNullSafe(F.col("text_crc32")).alias("lossless"),
    )


@query
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query
def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, folder, "pages").select("page_id", "url"))
    return judged.select(
        "page_id", "host", "path", "rule", "verdict", F.size("strict_hits").alias("n_strict"),
        F.size("soft_hits").alias("n_soft"),
    )


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = _table(spark, folder, "documents")
    told = manifest.manifest(docs, tampered, manifest.lower_cased(F.col("text")))
    siblings = F.transform("proof", lambda level: F.concat(level["left"], level["right"]))
    folded = manifest.folded(F.col("now"), F.col("proof"))
    told = told.withColumns({"proof_sha256": F.sha2(F.concat_ws("", siblings), 256), "folded_root": folded})
    return told.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


ORACLE_SQL["op10_top_k"] = oracles.TOP_K
ORACLE_SQL["op11_lexical_search"] = oracles.lexical_search()
ORACLE_SQL["op12_url_filter"] = oracles.url_filter()
ORACLE_SQL["op13_merkle_manifest"] = oracles.merkle_manifest()
