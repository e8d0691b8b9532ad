"""Building blocks on keys that stay even when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(*columns: str) -> Column:
    test = F.lit(True)
    for name in columns:
        test = test & F.col(name).isNotNull()
    return test


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], chooser) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # Rows that are equal in `order` are told apart by what they hold, whatever their place.
    ranked = F.struct(*order, F.xxhash64(*rest))
    chosen = chooser(F.struct(*rest), ranked).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "_row.*").select(*df.columns)


def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order``, ties by a hash of the row.

    An aggregate, not a window: rows are reduced before the shuffle, so a hot key
    sends one row per task.
    """
    return _pick(df, keys, order, F.min_by)


def pick_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``; see :func:`pick_first`."""
    return _pick(df, keys, order, F.max_by)


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join of many ``facts`` to a ``lookup`` that has one row per key.

    Spark broadcasts the lookup when its size allows. When it does not, both sides are
    shuffled and AQE splits the partition of a hot key over several tasks. It does so only
    where both sides come straight from a shuffle, so the key is wrapped: a lookup that was
    grouped by the key would else be joined where it lies.
    """
    keys = [key] if isinstance(key, str) else list(key)
    left = facts.withColumn("_key", F.struct(*keys))
    right = lookup.withColumn("_key", F.struct(*keys)).drop(*keys)
    joined = left.where(not_null(*keys)) if how == "inner" else left
    columns = [*keys, *[c for c in facts.columns if c not in keys],
               *[c for c in lookup.columns if c not in keys]]
    return joined.join(right, "_key", how).select(*columns)
