"""The data behind each chart and report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewire.functions.numbers import parse_units
from quotewire.operators.cleaning import pe_positive
from quotewire.operators.keyed import not_null
from quotewire.operators.quantiles import box
from quotewire.operators.ranking import top_movers
from quotewire.operators.summaries import PAIR_ORDER, aligned_negative, aligned_positive

# Topic nodes of the symbol graph; the third is never linked.
TOPICS = (
    "positive_performer",
    "negative_performer",
    "neutral_performer",
    "high_sentiment",
    "low_sentiment",
)


def label_shares(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    counts = df.where(not_null(label)).groupBy(F.col(label).alias("label")).agg(
        F.count("*").alias("count")
    )
    # the window spans the labels, not the rows
    return counts.withColumn("share", F.col("count") / F.sum("count").over(W.partitionBy()))


def price_histogram(quotes: DataFrame, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins over the whole price range, empty bins included."""
    prices = quotes.where(not_null("price"))
    ends = prices.agg(F.min("price").alias("low"), F.max("price").alias("high"))
    range_ = ends.select(F.struct("low", "high")).scalar()
    place = F.try_divide(F.col("price") - F.col("_r.low"), F.col("_r.high") - F.col("_r.low"))
    bin_no = F.least(F.lit(bins - 1), F.floor(F.coalesce(place, F.lit(0.0)) * bins).cast("int"))
    counts = (
        prices.withColumn("_r", range_).groupBy(bin_no.alias("bin")).agg(F.count("*").alias("count"))
    )
    width = (F.col("_r.high") - F.col("_r.low")) / bins
    every = quotes.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(counts, "bin", "left")
        .withColumn("_r", range_)
        .where("_r IS NOT NULL AND _r.low IS NOT NULL")
        .select(
            "bin",
            (F.col("_r.low") + F.col("bin") * width).alias("lower"),
            (F.col("_r.low") + (F.col("bin") + 1) * width).alias("upper"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
    )


def pe_box(quotes: DataFrame) -> DataFrame:
    """Box of the positive P/E ratios; nothing for fewer than two."""
    return box(pe_positive(quotes), "pe_ratio").where("n >= 2")


def return_box(matched: DataFrame) -> DataFrame:
    return box(matched, "daily_return", by=["sentiment_label"])


def cap_vs_volume(quotes: DataFrame) -> DataFrame:
    return quotes.select(
        "symbol",
        parse_units(F.col("volume")).alias("volume"),
        parse_units(F.col("market_cap")).alias("market_cap"),
        "change_percent",
    )


def sentiment_scatter(pairs: DataFrame) -> DataFrame:
    text = F.concat("stock_symbol", F.lit("<br>"), F.substring("news_headline", 1, 50), F.lit("..."))
    return pairs.select(
        "news_id", "sentiment_score", "daily_change_percent", "current_price", "stock_symbol",
        text.alias("text"),
    )


def movers_chart(quotes: DataFrame) -> DataFrame:
    return top_movers(quotes, 3)


def aligned_top(groups: DataFrame, n: int = 10) -> DataFrame:
    def top(df: DataFrame, side: str) -> DataFrame:
        return df.select("stock_symbol", "sentiment_score", F.lit(side).alias("side")).limit(n)

    return top(aligned_positive(groups), "positive").unionByName(
        top(aligned_negative(groups), "negative")
    )


def daily_digest(
    run: DataFrame, stocks: DataFrame, news: DataFrame, sentiment: DataFrame, correlation: DataFrame
) -> DataFrame:
    """The one-row summaries of a run side by side.

    Each argument is a one-row frame; it is read as a scalar subquery, not joined.
    """
    parts = {"stock": stocks, "news": news, "sentiment": sentiment, "correlation": correlation}
    row = run.withColumns({f"_{k}": df.select(F.struct("*")).scalar() for k, df in parts.items()})
    taken = list(run.columns)
    fields: list[Column] = []
    for k, df in parts.items():
        for c in df.columns:
            name = c if c not in taken else f"{k}_{c}"
            taken.append(name)
            fields.append(F.col(f"_{k}.{c}").alias(name))
    return row.select(*run.columns, *fields)


def symbol_topic_edges(pairs: DataFrame) -> DataFrame:
    """Weighted edges from symbols to topics; the latest pair sets an edge's weight."""
    score, change = F.col("sentiment_score"), F.col("daily_change_percent")
    performance = (
        F.when((change > 1) & (score > 0.2), "positive_performer")
        .when((change < -1) & (score < -0.2), "negative_performer")
    )
    mood = F.when(score > 0.5, "high_sentiment").when(score < -0.5, "low_sentiment")
    linked = pairs.select(
        F.col("stock_symbol").alias("src"),
        F.explode(F.array_compact(F.array(performance, mood))).alias("dst"),
        F.abs(score).alias("weight"),
        *PAIR_ORDER,
    )
    return linked.where(not_null("src")).groupBy("src", "dst").agg(
        F.max_by("weight", F.struct(*PAIR_ORDER)).alias("weight")
    )


def graph_nodes(pairs: DataFrame) -> DataFrame:
    """Every symbol and every topic, linked or not."""
    stocks = (
        pairs.where(not_null("stock_symbol")).select(F.col("stock_symbol").alias("node")).distinct()
        .withColumn("type", F.lit("stock"))
    )
    topics = pairs.sparkSession.createDataFrame([(t, "topic") for t in TOPICS], "node string, type string")
    return stocks.unionByName(topics)
