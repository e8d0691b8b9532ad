"""Joins of news to prices. All are inner equi-joins on a date or a symbol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewire.functions.dates import now_utc
from quotewire.functions.symbols import base_symbol
from quotewire.operators.keyed import lookup_join, not_null, pick_first, pick_last
from quotewire.operators.summaries import daily_news, daily_stock


def join_by_date(news: DataFrame, stock: DataFrame) -> DataFrame:
    """One row per date that has both news and prices.

    Both sides are reduced to one row per date before they meet.
    """
    return daily_news(news).join(daily_stock(stock), "date")


def integrate(
    quotes: DataFrame,
    posts: DataFrame,
    order: Sequence[str] = ("timestamp",),
    dedupe: bool = False,
    as_of: Column | None = None,
) -> DataFrame:
    """One row per mention of a quoted symbol in a post.

    A symbol matches by its base form. Where a quote repeats, the last by ``order``
    counts. 'BTC' and 'BTC-USD' in one post give two rows, or one with ``dedupe``.
    Posts that were never scored are neutral 0.0.
    """
    def scored(column: str, default: Column) -> Column:
        return F.coalesce(column, default) if column in posts.columns else default

    symbols = F.transform("stock_symbols", lambda s: base_symbol(s))
    mentions = posts.select(
        F.col("post_id").alias("news_id"),
        F.explode(F.array_distinct(symbols) if dedupe else symbols).alias("stock_symbol"),
        F.col("headline").alias("news_headline"),
        F.col("url").alias("news_url"),
        scored("sentiment_label", F.lit("neutral")).alias("news_sentiment"),
        scored("sentiment_score", F.lit(0.0)).alias("sentiment_score"),
        F.col("created_iso").alias("published_at"),
    )
    known = quotes.select(
        F.upper("symbol").alias("stock_symbol"),
        F.col("name").alias("stock_name"),
        F.col("price").alias("current_price"),
        F.col("change_percent").alias("daily_change_percent"),
        "market_cap",
        "volume",
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    ).where(not_null("stock_symbol"))
    latest = pick_last(known, ["stock_symbol"], [f"_o{i}" for i in range(len(order))])
    stamp = now_utc() if as_of is None else as_of
    return lookup_join(mentions, latest, "stock_symbol").select(
        "news_id", "stock_symbol", "stock_name", "current_price", "daily_change_percent",
        "market_cap", "volume", "news_headline", "news_url", "news_sentiment",
        "sentiment_score", "published_at", stamp.alias("analysis_timestamp"),
    )


def _first_returns(quotes: DataFrame, order: Sequence[str]) -> DataFrame:
    """First quote of each upper-case symbol by ``order``."""
    keyed = quotes.select(
        F.upper("symbol").alias("symbol"),
        F.coalesce("daily_return", F.lit(0.0)).alias("daily_return"),
        "total_volume",
        "price_volatility",
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    ).where(not_null("symbol"))
    firsts = pick_first(keyed, ["symbol"], [f"_o{i}" for i in range(len(order))])
    return firsts.select("symbol", "daily_return", "total_volume", "price_volatility")


def _dated(matched: DataFrame) -> DataFrame:
    return matched.withColumns(
        {"stock_date": F.col("news_date"), "stock_time": F.col("news_time")}
    )


def match_news(news: DataFrame, quotes: DataFrame, order: Sequence[str]) -> DataFrame:
    """News with the return of the first quote of its symbol. Not a join on time: the
    quote takes the article's date."""
    keyed = news.withColumn("symbol", F.upper("matched_symbol"))
    return _dated(lookup_join(keyed, _first_returns(quotes, order), "symbol"))


def match_news_or_default(news: DataFrame, quotes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Like :func:`match_news`, but where no article at all has a quote, every article
    is kept with return 0 and volume 0. Whether there is a hit is told by the symbols
    alone; the articles themselves are read once."""
    keyed = news.withColumn("symbol", F.upper("matched_symbol"))
    returns = _first_returns(quotes, order).withColumn("_hit", F.lit(True))
    joined = lookup_join(keyed, returns, "symbol", how="left")
    symbols = keyed.select("symbol").distinct().join(returns.select("symbol"), "symbol", "left_semi")
    none_found = symbols.agg(F.count("*")).scalar() == 0
    return _dated(
        joined.where(F.col("_hit").isNotNull() | none_found)
        .withColumn("daily_return", F.coalesce("daily_return", F.lit(0.0)))
        .withColumn(
            "total_volume",
            F.when(F.col("_hit").isNull(), F.lit(0.0)).otherwise(F.col("total_volume")),
        )
        .drop("_hit")
    )


def match_news_within(
    news: DataFrame, quotes: DataFrame, order: Sequence[str], window: str = "1 day"
) -> DataFrame:
    """News with the return of the quote of its symbol that is nearest in time.

    The quote lies within ``window`` of the article, before or after it; of two equally
    near ones the earlier counts, of several at one time the first by ``order``. Articles
    without such a quote, or without a time, are left out. stock_time and stock_date are
    the quote's.

    Only distinct (symbol, time) of the articles look for quotes, each among those of three
    buckets of time, so a symbol's news is dealt out by bucket and AQE splits a bucket that
    is still hot. The nearest is an aggregate over numbers; articles then fetch theirs.
    """
    span = news.sparkSession.sql(f"SELECT CAST(INTERVAL '{window}' AS INTERVAL DAY TO SECOND)").first()[0]
    width = max(1, round(span.total_seconds() * 1_000_000))
    keyed = news.withColumn("symbol", F.upper("matched_symbol")).where(not_null("news_time"))
    bucket = lambda at: F.floor(F.col(at) / width)
    kept = ("daily_return", "total_volume", "price_volatility")
    timed = quotes.where(not_null("symbol", "stock_time")).select(
        F.upper("symbol").alias("symbol"), F.unix_micros("stock_time").alias("_at"),
        F.coalesce("daily_return", F.lit(0.0)).alias("daily_return"),
        F.col("total_volume").cast("double").alias("total_volume"),
        F.col("price_volatility").cast("double").alias("price_volatility"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    )
    timed = pick_first(timed, ["symbol", "_at"], [f"_o{i}" for i in range(len(order))])
    near = timed.select("symbol", "_at", *kept, F.explode(
        F.array(*[(bucket("_at") + i).cast("long") for i in (-1, 0, 1)])
    ).alias("_bucket"))
    asked = keyed.select("symbol", F.unix_micros("news_time").alias("_time")).distinct()
    asked = asked.withColumn("_bucket", bucket("_time").cast("long"))
    # Both sides come straight from a shuffle by symbol and bucket, so AQE may split them.
    met = near.withColumn("_key", F.struct("symbol", "_bucket")).drop("symbol", "_bucket").join(
        asked.where(not_null("symbol")).withColumn("_key", F.struct("symbol", "_bucket")), "_key"
    )
    away = F.abs(F.col("_at") - F.col("_time"))
    met = met.where(away <= width).withColumn("_code", away * 2 + (F.col("_at") > F.col("_time")).cast("int"))
    found = met.groupBy("symbol", "_time").agg(
        F.min_by("_at", "_code").alias("_at"), *[F.min_by(c, "_code").alias(c) for c in kept]
    )
    articles = keyed.drop(*[c for c in kept if c in keyed.columns]).withColumn("_time", F.unix_micros("news_time"))
    joined = lookup_join(articles, found, ["symbol", "_time"])
    at = F.timestamp_micros("_at")
    return joined.withColumns({"stock_date": F.to_date(at), "stock_time": at}).drop("_time", "_at")
