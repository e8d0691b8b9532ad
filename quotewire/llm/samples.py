"""Bounded samples of rows for model fits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, most: int, strata: str, key: str = "doc_id") -> DataFrame:
    """About ``most`` rows at most, as many of each value of ``strata`` as there are or fit.

    Rows are drawn by a hash of ``key``, which no two rows share, so the same rows come back
    however the table is stored. ``most`` is shared evenly by the values; a value that has
    fewer leaves the rest unused.
    """
    sizes = {r[strata]: r["n"] for r in rows.groupBy(strata).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return rows
    share = most / len(sizes)
    chance = F.lit(0.0)
    for value, n in sizes.items():
        chance = F.when(F.col(strata).eqNullSafe(F.lit(value)), min(1.0, share / n)).otherwise(chance)
    spot = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 20)) / float(1 << 20)
    return rows.where(spot < chance)


def one_text_per_key(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """``rows`` (key, text, label) with one text of each key: that of the least hash.

    So a bounded sample of keys is a bounded sample of texts, whatever number of rows
    repeats a key; repeats are cut in each task before the shuffle.
    """
    least = F.struct(F.xxhash64("text"), "text")
    return rows.groupBy(key, "label").agg(F.min(least)["text"].alias("text"))


def labelled(labels: DataFrame, name: str, key: str = "doc_id") -> DataFrame:
    """Rows (key, name) of ``labels`` with value 0 or 1, one per key: the greatest."""
    known = labels.where(F.col(name).isin(0, 1) & F.col(key).isNotNull())
    return known.groupBy(key).agg(F.max(name).cast("int").alias(name))

