"""Correlation, trend line and the findings drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds and texts of the findings.
CORRELATION_LEVEL = 0.3
STRATEGY_LEVEL = 0.4
ACCURACY_LEVEL = 0.6
STRONG_POSITIVE_TEXT = "Strong positive correlation (%.3f) between news sentiment and stock performance"
STRONG_NEGATIVE_TEXT = "Strong negative correlation (%.3f) between news sentiment and stock performance"
WEAK_TEXT = "Weak correlation (%.3f) between news sentiment and stock performance"
ACCURACY_TEXT = "Sentiment-based prediction model achieved %.1f%% accuracy"
MOMENTUM_TEXT = (
    "Consider sentiment momentum strategy: "
    "Buy stocks with consistently positive news sentiment"
)
CONTRARIAN_TEXT = (
    "Consider contrarian strategy: "
    "Buy stocks with negative sentiment but strong fundamentals"
)
MONITORING_TEXT = (
    "Monitor stocks with high sentiment volatility for potential trading opportunities"
)
RESEARCH_TEXT = (
    "Further investigate lag effects between sentiment peaks and price movements"
)


def pearson(x: str, y: str) -> Column:
    """Correlation as an aggregate; NULL (not an error) for a constant column."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def sentiment_price_corr(groups: DataFrame) -> DataFrame:
    """Correlation of mean score and mean change over symbols, 4 places; 0 for at most
    one symbol."""
    found = pearson("sentiment_score", "daily_change_percent")
    # Keeps the sign of what rounds to zero, as round() in SQL does.
    places = F.signum(found) * (F.floor(F.abs(found) * 1e4 + 0.5) / 1e4)
    value = F.when(F.count("*") <= 1, F.lit(0.0)).otherwise(places)
    return groups.agg(value.alias("overall_correlation"))


def trend_line(pairs: DataFrame, points: int = 100) -> DataFrame:
    """Least-squares line of change over score at evenly spaced scores.

    Nothing for fewer than two pairs.
    """
    x, y = "sentiment_score", "daily_change_percent"
    complete = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    fit = complete.agg(
        F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high"),
        F.avg(x).alias("mx"), F.avg(y).alias("my"),
        F.try_divide(F.covar_pop(x, y), F.var_pop(x)).alias("slope"),
    ).where("n > 1")
    at = F.col("low") + F.col("point") * (F.col("high") - F.col("low")) / (points - 1)
    return (
        fit.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", at)
        .select("point", "x", (F.col("my") + F.col("slope") * (F.col("x") - F.col("mx"))).alias("y"))
    )


# --- findings -------------------------------------------------------------------------


def three_places(c: Column) -> Column:
    """``c`` as C's ``%.3f`` writes it: by its exact binary value, true halves to even.

    Java rounds the shortest decimal text of a double up instead, so 0.0045, which lies just
    below the half, would become 0.005. The product by 1000 is kept exact in two parts.
    """
    size = F.abs(c)
    high = size.cast("float").cast("double")
    low = size - high
    whole = F.floor(size * 1000).cast("double")
    over = (high * 1000 - whole - 0.5) + low * 1000
    up = (over > 0) | ((over == 0) & (whole % 2 == 1))
    places = (whole + F.when(up, 1.0).otherwise(0.0)) / 1000
    minus = F.when((c < 0) | (c.cast("string") == "-0.0"), "-").otherwise("")
    return F.concat(minus, F.format_string("%.3f", places))


def report_findings(
    pairs: DataFrame, correlation: DataFrame, model: DataFrame | None = None
) -> DataFrame:
    """Findings and recommendations as rows (section, item, text).

    ``correlation`` has one row with overall_correlation, ``model`` one row with
    classification_accuracy and sample_size. A NULL correlation counts as weak.
    """
    facts = pairs.agg(
        F.count_distinct("stock_symbol").alias("stocks"), F.count("*").alias("articles")
    ).withColumn("c", correlation.select("overall_correlation").scalar())
    if model is None:
        facts = facts.withColumns({"accuracy": F.lit(0.0), "n": F.lit(0).cast("long")})
    else:
        facts = facts.withColumns({
            "accuracy": model.select("classification_accuracy").scalar(),
            "n": model.select("sample_size").scalar(),
        })
    c = F.coalesce("c", F.lit(0.0))
    shown = three_places(c)
    strength = (
        F.when(c > CORRELATION_LEVEL, F.format_string(STRONG_POSITIVE_TEXT.replace("%.3f", "%s"), shown))
        .when(c < -CORRELATION_LEVEL, F.format_string(STRONG_NEGATIVE_TEXT.replace("%.3f", "%s"), shown))
        .otherwise(F.format_string(WEAK_TEXT.replace("%.3f", "%s"), shown))
    )
    mood = (
        F.when(c > CORRELATION_LEVEL, "positive")
        .when(c < -CORRELATION_LEVEL, "negative").otherwise("neutral")
    )
    strategy = F.when(c > STRATEGY_LEVEL, MOMENTUM_TEXT).when(c < -STRATEGY_LEVEL, CONTRARIAN_TEXT)
    accurate = F.when(
        F.col("accuracy") > ACCURACY_LEVEL,
        F.format_string(ACCURACY_TEXT, F.col("accuracy") * 100),
    )
    rows = [
        ("sample_size", "stocks_analyzed", F.col("stocks").cast("string")),
        ("sample_size", "news_articles", F.col("articles").cast("string")),
        ("sample_size", "prediction_sample_size", F.col("n").cast("string")),
        ("executive_summary", "market_sentiment", mood),
        ("key_findings", "correlation", strength),
        ("key_findings", "prediction", accurate),
        ("trading_strategies", "strategy", strategy),
        ("monitoring_alerts", "alert", F.lit(MONITORING_TEXT)),
        ("research_directions", "direction", F.lit(RESEARCH_TEXT)),
    ]
    entries = F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(i).alias("item"), t.alias("text"))
        for s, i, t in rows
    ])
    return facts.select(F.inline(entries)).where("text IS NOT NULL")

