"""Grouped and global summaries.

All are plain aggregates: Spark pre-aggregates per task, so a hot key costs one
partial row per task. Rows with a NULL group key are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewire.functions.dates import time_period
from quotewire.functions.labels import sentiment_level, sentiment_type
from quotewire.operators.keyed import not_null

PAIR_ORDER = ("published_at", "news_id")


def _by(df: DataFrame, *keys: str) -> GroupedData:
    return df.where(not_null(*keys)).groupBy(*keys)


def ordered_first(column: str, order: Sequence[str]) -> Column:
    """First non-NULL value by ``order``."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))


def ordered_last(column: str, order: Sequence[str]) -> Column:
    """Last non-NULL value by ``order``, the greatest of several at one place."""
    place = F.struct(*order).alias("place")
    return F.max(F.when(F.col(column).isNotNull(), F.struct(place, F.col(column).alias("v"))))["v"]


def ordered_last_two(a: str, b: str, order: Sequence[str]) -> list[Column]:
    """:func:`ordered_last` of two columns that are mostly set together, in one narrow state.

    Rows with both values keep one place and both; only those with one of them need a state
    of their own.
    """
    both, place = F.col(a).isNotNull() & F.col(b).isNotNull(), F.struct(*order).alias("place")
    pair = F.max(F.when(both, F.struct(place, F.col(a).alias("a"), F.col(b).alias("b"))))

    def last(own: str, name: str) -> Column:
        alone = F.max(F.when(F.col(own).isNotNull() & ~both, F.struct(place, F.col(own).alias("v"))))
        later = alone.isNotNull() & (pair.isNull() | (alone["place"] > pair["place"]))
        return F.when(later, alone["v"]).otherwise(pair[name]).alias(own)

    return [last(a, "a"), last(b, "b")]


# --- dated news and prices ------------------------------------------------------------


def daily_news(news: DataFrame) -> DataFrame:
    return news.groupBy(F.col("newsDate").alias("date")).agg(
        F.count("newsId").alias("dailyNewsCount"),
        F.avg("sentiment").alias("dailyAvgSentiment"),
    )


def daily_stock(stock: DataFrame) -> DataFrame:
    return stock.groupBy("date").agg(
        F.avg("dailyReturn").alias("dailyAvgReturn"),
        F.sum("volume").alias("dailyTotalVolume"),
    )


def sentiment_vs_return(joined: DataFrame) -> DataFrame:
    """Average return (percent) and number of days per day mood."""
    mood = sentiment_type(F.col("dailyAvgSentiment")).alias("sentimentType")
    return joined.groupBy(mood).agg(
        (F.avg("dailyAvgReturn") * 100).alias("avgReturn(%)"),
        F.count("date").alias("dayCount"),
    )


def sentiment_dist(news: DataFrame) -> DataFrame:
    """Articles per mood and their share, from one pass over the news."""
    counts = news.groupBy(sentiment_level(F.col("sentiment")).alias("sentimentLevel")).agg(
        F.count("newsId").alias("count")
    )
    total = F.sum("count").over(W.partitionBy())  # over the three moods
    return counts.withColumn("percentage(%)", F.col("count") / total * 100)


def top_sources(news: DataFrame, n: int = 10) -> DataFrame:
    return (
        news.groupBy("newsSource")
        .agg(F.count("newsId").alias("articleCount"))
        .orderBy(F.desc("articleCount"), "newsSource")
        .limit(n)
    )


def return_stats(stock: DataFrame) -> DataFrame:
    r = F.col("dailyReturn")
    return stock.agg(
        (F.avg(r) * 100).alias("avgReturn(%)"),
        (F.stddev_samp(r) * 100).alias("stdReturn(%)"),
        (F.max(r) * 100).alias("maxReturn(%)"),
        (F.min(r) * 100).alias("minReturn(%)"),
    )


# --- quotes and posts -----------------------------------------------------------------


def stock_summary(quotes: DataFrame) -> DataFrame:
    change = F.col("change_percent")
    return quotes.agg(
        F.count("*").alias("total_stocks"),
        F.avg("price").alias("average_price"),
        F.avg(change).alias("average_change_percent"),
        F.count_if(change > 0).alias("positive_changes"),
        F.count_if(change < 0).alias("negative_changes"),
    )


def mentions(posts: DataFrame) -> DataFrame:
    """One row per mentioned symbol."""
    return posts.select(F.explode("stock_symbols").alias("ticker"))


def unique_tickers(posts: DataFrame) -> DataFrame:
    return mentions(posts).distinct()


def news_summary(posts: DataFrame) -> DataFrame:
    size = F.coalesce(F.size("stock_symbols"), F.lit(0))
    unique = unique_tickers(posts).agg(F.count("*"))
    return posts.agg(
        F.count("*").alias("total_articles"),
        F.count_if(size > 0).alias("articles_with_stock_symbols"),
        F.coalesce(F.sum(F.greatest(size, F.lit(0))), F.lit(0)).alias("total_stock_mentions"),
    ).withColumn("unique_tickers", unique.scalar())


def ticker_mentions(posts: DataFrame, n: int = 10) -> DataFrame:
    return (
        mentions(posts).groupBy("ticker").agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "ticker").limit(n)
    )


def sentiment_summary(scored: DataFrame) -> DataFrame:
    """Counts and percentages per label and the average score, in one pass."""
    label = F.col("sentiment_label")
    counts = scored.agg(
        F.count("*").alias("total_articles"),
        *[F.count_if(label == x).alias(f"{x}_count") for x in ("positive", "negative", "neutral")],
        F.avg(F.coalesce("sentiment_score", F.lit(0.0))).alias("average_sentiment_score"),
    )
    share = {
        f"{x}_percentage": F.round(F.try_divide(F.col(f"{x}_count"), "total_articles") * 100, 2)
        for x in ("positive", "negative", "neutral")
    }
    return counts.withColumns(share).withColumn(
        "average_sentiment_score", F.round("average_sentiment_score", 4)
    )


def extreme_articles(scored: DataFrame, key: str = "post_id") -> DataFrame:
    """The article with the highest and the one with the lowest score; ties by ``key``."""
    row, score = F.struct(*scored.columns), F.coalesce("sentiment_score", F.lit(0.0))
    both = scored.agg(
        F.min_by(row, F.struct(-score, F.col(key))).alias("most_positive"),
        F.min_by(row, F.struct(score, F.col(key))).alias("most_negative"),
    )
    return both.select(
        F.stack(
            F.lit(2), F.lit("most_positive"), F.col("most_positive"),
            F.lit("most_negative"), F.col("most_negative"),
        ).alias("extreme", "_row")
    ).where("_row IS NOT NULL").select("extreme", "_row.*")


# --- stock-news pairs -----------------------------------------------------------------


def symbol_groups(pairs: DataFrame, order: Sequence[str] = PAIR_ORDER) -> DataFrame:
    """Mean score and change, most frequent label (ties: first by name) and the first
    name, price and market cap of each symbol."""
    return _by(pairs, "stock_symbol").agg(
        F.avg("sentiment_score").alias("sentiment_score"),
        F.avg("daily_change_percent").alias("daily_change_percent"),
        F.mode("news_sentiment", deterministic=True).alias("news_sentiment"),
        ordered_first("stock_name", order).alias("stock_name"),
        ordered_first("current_price", order).alias("current_price"),
        ordered_first("market_cap", order).alias("market_cap"),
    )


def aligned_positive(groups: DataFrame) -> DataFrame:
    """Symbols with clearly positive mood and rising price, best mood first."""
    return groups.where("sentiment_score > 0.1 AND daily_change_percent > 0").orderBy(
        F.desc("sentiment_score"), "stock_symbol"
    )


def aligned_negative(groups: DataFrame) -> DataFrame:
    """Symbols with clearly negative mood and falling price, worst mood first."""
    return groups.where("sentiment_score < -0.1 AND daily_change_percent < 0").orderBy(
        "sentiment_score", "stock_symbol"
    )


def aligned_counts(groups: DataFrame) -> DataFrame:
    score, change = F.col("sentiment_score"), F.col("daily_change_percent")
    return groups.agg(
        F.count_if((score > 0.1) & (change > 0)).alias("positive_correlations"),
        F.count_if((score < -0.1) & (change < 0)).alias("negative_correlations"),
    )


def pair_label_counts(pairs: DataFrame) -> DataFrame:
    label = F.col("news_sentiment")
    return pairs.agg(
        F.count("*").alias("total_stock_news_pairs"),
        F.count_distinct("stock_symbol").alias("unique_stocks_analyzed"),
        *[F.count_if(label == x).alias(x) for x in ("positive", "negative", "neutral")],
    )


def cluster_features(pairs: DataFrame) -> DataFrame:
    return _by(pairs, "stock_symbol").agg(
        F.avg("sentiment_score").alias("sentiment_score"),
        F.avg("daily_change_percent").alias("daily_change_percent"),
        F.count("*").alias("news_count"),
        F.avg("current_price").alias("current_price"),
    )


def top_performers(pairs: DataFrame, n: int = 10, order: Sequence[str] = PAIR_ORDER) -> DataFrame:
    return (
        _by(pairs, "stock_symbol").agg(
            F.avg("daily_change_percent").alias("daily_change_percent"),
            F.avg("sentiment_score").alias("sentiment_score"),
            ordered_first("stock_name", order).alias("stock_name"),
        )
        .orderBy(F.desc("daily_change_percent"), "stock_symbol").limit(n)
    )


# --- articles matched to returns ------------------------------------------------------


def _mean_abs_return() -> Column:
    return F.avg(F.abs(F.col("daily_return")))


def sentiment_return(matched: DataFrame) -> DataFrame:
    return _by(matched, "sentiment_label").agg(
        F.avg("daily_return").alias("avg_return"),
        F.stddev_samp("daily_return").alias("return_std"),
        F.count("daily_return").alias("sample_count"),
    )


def event_impact(matched: DataFrame) -> DataFrame:
    return _by(matched, "event_type").agg(
        _mean_abs_return().alias("avg_abs_return"),
        F.stddev_samp("daily_return").alias("volatility"),
        F.count("daily_return").alias("sample_count"),
    ).orderBy(F.desc_nulls_last("volatility"), "event_type")


def news_volume(matched: DataFrame, volume: str = "total_volume") -> DataFrame:
    """Articles per symbol and day next to each distinct volume and return that day.

    Articles are counted by volume and return in one pass; the sum per day runs over
    those counts, a row for each value there was that day.
    """
    days = ["symbol", "news_date"]
    known = matched.where(not_null(*days)).withColumn("total_volume", F.col(volume))
    counts = known.groupBy(*days, "total_volume", "daily_return").agg(F.count("*").alias("_n"))
    return counts.select(
        *days, F.sum("_n").over(W.partitionBy(*days)).alias("daily_news_count"),
        "total_volume", "daily_return",
    )


def source_impact(matched: DataFrame, min_news: int = 2) -> DataFrame:
    return (
        _by(matched, "source").agg(
            _mean_abs_return().alias("avg_abs_return"),
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.count("daily_return").alias("news_count"),
        )
        .where(F.col("news_count") >= min_news)
        .orderBy(F.desc("avg_abs_return"), "source")
    )


def time_period_impact(matched: DataFrame) -> DataFrame:
    return (
        matched.where(not_null("news_time"))
        .groupBy(time_period(F.col("news_time")).alias("time_period"))
        .agg(
            _mean_abs_return().alias("avg_abs_return"),
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.count("daily_return").alias("sample_count"),
        )
    )


def symbol_impact(matched: DataFrame) -> DataFrame:
    return _by(matched, "symbol").agg(
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.avg("daily_return").alias("avg_return"),
        F.count("daily_return").alias("sample_count"),
    ).orderBy(F.desc_nulls_last("avg_return"), "symbol")


def symbol_news_volume(matched: DataFrame, volume: str = "total_volume") -> DataFrame:
    return _by(matched, "symbol").agg(
        F.count("symbol").alias("news_count"), F.avg(volume).alias("avg_volume")
    )


def sentiment_impact_gap(matched: DataFrame) -> DataFrame:
    """Average return of POSITIVE minus that of NEGATIVE articles; a missing side is 0."""

    def side(label: str) -> Column:
        mean = F.avg(F.when(F.col("sentiment_label") == label, F.col("daily_return")))
        return F.coalesce(mean, F.lit(0.0))

    return matched.agg((side("POSITIVE") - side("NEGATIVE")).alias("overall_sentiment_impact"))


# --- whole runs -----------------------------------------------------------------------


def run_summary(
    quotes: DataFrame, posts: DataFrame, scored: DataFrame | None, pairs: DataFrame
) -> DataFrame:
    """One row with the size of every stage of a run."""

    def rows(df: DataFrame | None) -> Column:
        return F.lit(0).cast("long") if df is None else df.agg(F.count("*")).scalar()

    return quotes.agg(F.count("*").alias("stocks_crawled")).select(
        "stocks_crawled",
        rows(posts).alias("news_articles_crawled"),
        rows(scored).alias("articles_with_sentiment"),
        rows(pairs).alias("stock_news_integrations"),
        F.lit(scored is None).alias("sentiment_analysis_skipped"),
    )


def run_summary_of(
    stocks: DataFrame, news: DataFrame, sentiment: DataFrame | None, labels: DataFrame
) -> DataFrame:
    """:func:`run_summary` from the one-row summaries of the stages, which count them anyway."""

    def size(df: DataFrame | None, column: str) -> Column:
        return F.lit(0).cast("long") if df is None else df.select(column).scalar()

    return stocks.select(
        F.col("total_stocks").alias("stocks_crawled"),
        size(news, "total_articles").alias("news_articles_crawled"),
        size(sentiment, "total_articles").alias("articles_with_sentiment"),
        size(labels, "total_stock_news_pairs").alias("stock_news_integrations"),
        F.lit(sentiment is None).alias("sentiment_analysis_skipped"),
    )
