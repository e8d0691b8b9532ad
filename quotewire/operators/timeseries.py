"""Daily series per symbol.

Raw pairs are first reduced to one row per symbol and day, so every window below
holds at most as many rows as there are days, however much news a symbol has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewire.functions.dates import to_timestamp_coerce
from quotewire.functions.symbols import sector_of
from quotewire.operators.keyed import not_null
from quotewire.operators.summaries import PAIR_ORDER, ordered_last, ordered_last_two

# Row lags of the score, row steps of the price change.
SENTIMENT_LAGS = (1, 2, 3, 5, 7)
PRICE_STEPS = (1, 3, 5)
VOLATILITY_ROWS = 5
MIN_DAYS = 5
STRONG_SENTIMENT = 0.3


def _utc_day(column: str) -> Column:
    """UTC day of a written time; NULL where the text is none, the empty text included."""
    return F.to_date(to_timestamp_coerce(F.col(column)))


def _by_day() -> WindowSpec:
    return W.partitionBy("stock_symbol").orderBy("date")


def daily_symbol(
    pairs: DataFrame, order: Sequence[str] = PAIR_ORDER, volume: bool = True
) -> DataFrame:
    """Mean score and change, last price and volume, and article count per day.

    Without ``volume`` no state is kept for it, which makes each row of the shuffle narrower.
    """
    last = (
        ordered_last_two("current_price", "volume", order) if volume
        else [ordered_last("current_price", order).alias("current_price")]
    )
    return (
        pairs.withColumn("date", _utc_day("published_at"))
        .where(not_null("stock_symbol"))
        .groupBy("stock_symbol", "date")
        .agg(
            F.avg("sentiment_score").alias("sentiment_score"),
            F.avg("daily_change_percent").alias("daily_change_percent"),
            *last,
            F.count("news_id").alias("news_count"),
            F.count("date").alias("_dated"),
        )
        # Asked of the groups, as a filter on the raw rows would parse each time twice.
        .where("_dated > 0").drop("_dated")
    )


def sentiment_lags(daily: DataFrame, lags: Sequence[int] = SENTIMENT_LAGS) -> DataFrame:
    return daily.withColumns(
        {f"sentiment_lag_{k}": F.lag("sentiment_score", k).over(_by_day()) for k in lags}
    )


def price_changes(daily: DataFrame, steps: Sequence[int] = PRICE_STEPS) -> DataFrame:
    """Relative change over k rows; NULL after a zero price."""

    def change(k: int) -> Column:
        return F.try_divide("current_price", F.lag("current_price", k).over(_by_day())) - 1

    return daily.withColumns({f"price_change_{k}d": change(k) for k in steps})


def rolling_volatility(daily: DataFrame, rows: int = VOLATILITY_ROWS) -> DataFrame:
    """Sample deviation of the last daily changes; NULL for a single value."""
    recent = _by_day().rowsBetween(1 - rows, 0)
    return daily.withColumn(
        f"volatility_{rows}d", F.stddev_samp("price_change_1d").over(recent)
    )


def time_series_features(pairs: DataFrame, volume: bool = True) -> DataFrame:
    """Daily series with lags, price changes and volatility; days without all lags
    are dropped."""
    daily = daily_symbol(pairs, volume=volume)
    daily = rolling_volatility(price_changes(sentiment_lags(daily)))
    return daily.where(not_null(*[f"sentiment_lag_{k}" for k in SENTIMENT_LAGS]))


def market_daily(series: DataFrame, min_days: int = MIN_DAYS) -> DataFrame:
    """Market-wide day rows; nothing for fewer than ``min_days`` days."""
    days = series.groupBy("date").agg(
        F.avg("sentiment_score").alias("sentiment_score"),
        F.avg("price_change_1d").alias("price_change_1d"),
        F.sum("news_count").alias("news_count"),
    )
    # Counted by a window over the days, a row each, so the series is worked out once.
    counted = days.withColumn("_days", F.count("date").over(W.partitionBy()))
    return counted.where(F.col("_days") >= min_days).drop("_days")


def symbol_recent(
    series: DataFrame, symbol: str, days: int = 30, min_days: int = MIN_DAYS
) -> DataFrame:
    """The last ``days`` rows of one symbol, oldest first, with strong scores flagged."""
    own = series.where(F.col("stock_symbol") == symbol)
    enough = own.agg(F.count("*")).scalar() >= min_days
    return (
        own.where(enough)
        .withColumn("strong_sentiment", F.abs("sentiment_score") > STRONG_SENTIMENT)
        .orderBy(F.desc("date")).limit(days).orderBy("date")
    )


def sector_daily(pairs: DataFrame) -> DataFrame:
    """Mean score per sector and day; nothing for fewer than two sectors."""
    placed = pairs.where(not_null("stock_symbol")).select(
        sector_of(F.col("stock_symbol")).alias("sector"),
        _utc_day("published_at").alias("date"),
        "sentiment_score",
    )
    daily = placed.where(not_null("date")).groupBy("sector", "date").agg(F.avg("sentiment_score").alias("sentiment_score"))
    ends = daily.agg((F.min("sector") < F.max("sector")).alias("several"))
    return daily.where(ends.scalar())


def sector_heatmap(pairs: DataFrame, dates: Sequence[str]) -> DataFrame:
    """:func:`sector_daily` with one column per given date ('yyyy-MM-dd')."""
    return (
        sector_daily(pairs)
        .withColumn("date", F.date_format("date", "yyyy-MM-dd"))
        .groupBy("sector").pivot("date", list(dates)).agg(F.first("sentiment_score"))
    )
