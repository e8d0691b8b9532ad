"""Top-k reports, first rows per group, unions and de-duplication.

Every top-k has a unique tie-breaker and becomes a per-task top-k in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewire.operators.keyed import not_null, pick_first


# Spark cuts groups before the shuffle for limits up to this one.
SPARK_GROUP_LIMIT = 1000
GROUP_PARTS = 64


def _both_ends(df: DataFrame, by: str, key: str, n: int, high: str, low: str) -> DataFrame:
    ranked = df.where(not_null(by))
    top = ranked.orderBy(F.desc(by), key).limit(n).withColumn("side", F.lit(high))
    bottom = ranked.orderBy(by, key).limit(n).withColumn("side", F.lit(low))
    return top.unionByName(bottom)


def top_movers(quotes: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest and ``n`` smallest changes."""
    rows = quotes.select("symbol", "name", "change_percent")
    return _both_ends(rows, "change_percent", "symbol", n, "gainer", "loser")


def top_sentiment_symbols(groups: DataFrame, n: int = 5) -> DataFrame:
    rows = groups.select("stock_symbol", "stock_name", "sentiment_score", "daily_change_percent")
    return _both_ends(rows, "sentiment_score", "stock_symbol", n, "positive", "negative")


def top_mentioned_stocks(pairs: DataFrame, n: int = 10) -> DataFrame:
    return (
        pairs.where(not_null("stock_symbol"))
        .groupBy("stock_symbol").agg(F.count("*").alias("mentions"))
        .orderBy(F.desc("mentions"), "stock_symbol").limit(n)
    )


def limit_per_group(df: DataFrame, group: str, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows of every group; each task cuts its groups before the shuffle.

    Spark does so by itself up to a limit. Beyond it, groups are cut in ``GROUP_PARTS``
    parts first, by a hash of the row, so a hot group is ranked in as many tasks.
    """
    def cut(rows: DataFrame, *by: str) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
        return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")

    if n > SPARK_GROUP_LIMIT:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(GROUP_PARTS))
        df = cut(df.withColumn("_part", part), group, "_part").drop("_part")
    return cut(df, group)


def limit_total(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def first_per_symbol(df: DataFrame, order: Sequence[str], key: str = "symbol") -> DataFrame:
    return pick_first(df, [key], order)


def dedup_symbols(
    quotes: DataFrame, order: Sequence[str], batch: str | None = None
) -> DataFrame:
    """First quote per symbol, within each ``batch`` where one is named."""
    return pick_first(quotes, ["symbol"] if batch is None else [batch, "symbol"], order)


def union_snapshots(*frames: DataFrame) -> DataFrame:
    """All rows over the union of the columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
