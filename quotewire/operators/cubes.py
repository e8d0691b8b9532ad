"""All grouped tables of one input from one pass over it, by grouping sets.

A cube holds a few rows per group and set. The tables of a workflow are small selections
of its cube, so a workflow that writes the cube once reads each input once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewire.functions.dates import time_period
from quotewire.functions.labels import sentiment_level
from quotewire.operators.keyed import not_null


def cube(df: DataFrame, sets: Sequence[Sequence[str]], **measures: Column) -> DataFrame:
    """``measures`` of ``df`` by each of ``sets``; ``set`` numbers the set of a row.

    An empty ``df`` gives no rows, not even for the empty set; tables of one row are
    aggregates of that set, so that they have theirs.
    """
    keys = list(dict.fromkeys(c for own in sets for c in own))
    spots = {  # Spark's grouping_id: a bit for every key that is not in the set
        sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in own): number
        for number, own in enumerate(sets)
    }
    number = F.element_at(F.create_map(*[F.lit(v) for kv in spots.items() for v in kv]), F.col("_id"))
    grouped = df.groupingSets([[F.col(f"`{c}`") for c in own] for own in sets], *[F.col(f"`{c}`") for c in keys])
    return grouped.agg(
        F.grouping_id().cast("int").alias("_id"), *[m.alias(name) for name, m in measures.items()]
    ).withColumn("set", number).drop("_id")


def _of(table: DataFrame, number: int, *keys: str) -> DataFrame:
    """The rows of one set; with ``keys``, those where none of them is NULL."""
    return table.where((F.col("set") == number) & not_null(*keys))


# --- dated news and prices --------------------------------------------------------------

SOURCE, MOOD, DAY = range(3)


def news_cube(news: DataFrame) -> DataFrame:
    """Clean news by source, by mood and by day."""
    placed = news.withColumn("sentimentLevel", sentiment_level(F.col("sentiment")))
    return cube(
        placed, [["newsSource"], ["sentimentLevel"], ["newsDate"]],
        n=F.count("newsId"), mean=F.avg("sentiment"),
    )


def top_sources(news: DataFrame, n: int = 10) -> DataFrame:
    rows = _of(news, SOURCE).select("newsSource", F.col("n").alias("articleCount"))
    return rows.orderBy(F.desc("articleCount"), "newsSource").limit(n)


def sentiment_dist(news: DataFrame) -> DataFrame:
    rows = _of(news, MOOD).select("sentimentLevel", F.col("n").alias("count"))
    return rows.withColumn("percentage(%)", F.col("count") / rows.agg(F.sum("count")).scalar() * 100)


def daily_news(news: DataFrame) -> DataFrame:
    return _of(news, DAY).select(
        F.col("newsDate").alias("date"), F.col("n").alias("dailyNewsCount"), F.col("mean").alias("dailyAvgSentiment")
    )


PRICE_DAY, TREND, ALL_PRICES = range(3)


def stock_cube(stock: DataFrame, stock_code: str) -> DataFrame:
    """Clean prices by day, by the bar of one stock, and altogether.

    Bars of other stocks fall into one group; equal bars of the stock are counted.
    """
    bar = F.when(F.col("stockCode") == stock_code, F.struct("date", "open", "close", "volume"))
    r = F.col("dailyReturn")
    return cube(
        stock.withColumn("bar", bar), [["date"], ["bar"], []],
        n=F.count("*"), mean=F.avg(r), sd=F.stddev_samp(r), most=F.max(r), least=F.min(r),
        dailyTotalVolume=F.sum("volume"),
    )


def daily_stock(stock: DataFrame) -> DataFrame:
    return _of(stock, PRICE_DAY).select("date", F.col("mean").alias("dailyAvgReturn"), "dailyTotalVolume")


def return_stats(stock: DataFrame) -> DataFrame:
    names = {"mean": "avgReturn(%)", "sd": "stdReturn(%)", "most": "maxReturn(%)", "least": "minReturn(%)"}
    return _of(stock, ALL_PRICES).agg(*[(F.max(c) * 100).alias(name) for c, name in names.items()])


def stock_trend(stock: DataFrame) -> DataFrame:
    copies = F.explode(F.array_repeat("bar", F.col("n").cast("int"))).alias("bar")
    return _of(stock, TREND, "bar").select(copies).select("bar.*").orderBy("date")


# --- articles matched to returns --------------------------------------------------------

LABEL, OUTLET, PERIOD, SYMBOL, EVENT, ALL_MATCHES = range(6)


def matched_cube(matched: DataFrame) -> DataFrame:
    """Matched articles by label, source, time of day, symbol, event and altogether."""
    r = F.col("daily_return")
    period = F.when(F.col("news_time").isNotNull(), time_period(F.col("news_time")))
    placed = matched.withColumn("time_period", period)
    if "event_type" not in matched.columns:
        placed = placed.withColumn("event_type", F.lit(None).cast("string"))
    of = lambda label: F.avg(F.when(F.col("sentiment_label") == label, r))
    return cube(
        placed, [["sentiment_label"], ["source"], ["time_period"], ["symbol"], ["event_type"], []],
        rows=F.count("*"), n=F.count(r), mean=F.avg(r), sd=F.stddev_samp(r), mean_abs=F.avg(F.abs(r)),
        sentiment=F.avg("sentiment_score"), up=of("POSITIVE"), down=of("NEGATIVE"),
    )


def sentiment_return(matched: DataFrame) -> DataFrame:
    return _of(matched, LABEL, "sentiment_label").select(
        "sentiment_label", F.col("mean").alias("avg_return"), F.col("sd").alias("return_std"),
        F.col("n").alias("sample_count"),
    )


def source_impact(matched: DataFrame, min_news: int = 2) -> DataFrame:
    return _of(matched, OUTLET, "source").where(F.col("n") >= min_news).select(
        "source", F.col("mean_abs").alias("avg_abs_return"), F.col("sentiment").alias("avg_sentiment"),
        F.col("n").alias("news_count"),
    ).orderBy(F.desc("avg_abs_return"), "source")


def time_period_impact(matched: DataFrame) -> DataFrame:
    return _of(matched, PERIOD, "time_period").select(
        "time_period", F.col("mean_abs").alias("avg_abs_return"), F.col("sentiment").alias("avg_sentiment"),
        F.col("n").alias("sample_count"),
    )


def symbol_impact(matched: DataFrame) -> DataFrame:
    return _of(matched, SYMBOL, "symbol").select(
        "symbol", F.col("sentiment").alias("avg_sentiment"), F.col("mean").alias("avg_return"),
        F.col("n").alias("sample_count"),
    ).orderBy(F.desc_nulls_last("avg_return"), "symbol")


def event_impact(matched: DataFrame) -> DataFrame:
    return _of(matched, EVENT, "event_type").select(
        "event_type", F.col("mean_abs").alias("avg_abs_return"), F.col("sd").alias("volatility"),
        F.col("n").alias("sample_count"),
    ).orderBy(F.desc_nulls_last("volatility"), "event_type")


def sentiment_impact_gap(matched: DataFrame) -> DataFrame:
    side = lambda c: F.coalesce(F.max(c), F.lit(0.0))
    return _of(matched, ALL_MATCHES).agg((side("up") - side("down")).alias("overall_sentiment_impact"))


def total_matches(matched: DataFrame) -> DataFrame:
    return _of(matched, ALL_MATCHES).agg(F.coalesce(F.max("rows"), F.lit(0)).alias("total_matches"))
