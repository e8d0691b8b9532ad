"""Cleaning of news, price, quote and article tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.functions.dates import news_date, to_timestamp_coerce
from quotewire.functions.numbers import parse_volume, to_numeric_coerce
from quotewire.functions.symbols import UNKNOWN, first_symbol, symbol_from_text
from quotewire.functions.text import headline_fallback, join_paragraphs
from quotewire.operators.keyed import not_null

# Names under which a column may arrive, in order of preference.
QUOTE_ALIASES = {
    "symbol": ("symbol", "ticker", "stock_symbol"),
    "price": ("price", "current_price", "regularMarketPrice"),
    "volume": ("volume", "dayvolume", "regularMarketVolume"),
    "name": ("name", "companyname", "company_name"),
    "change_percent": ("change_percent", "changePercent", "percentchange"),
}
ARTICLE_ALIASES = {
    "text_raw": ("text_raw", "clean_text", "body", "body_texts"),
    "headline": ("headline", "title", "news_headline"),
    "created_iso": ("created_iso", "publish_date_iso", "timestamp_utc", "created_utc"),
    "source": ("source", "publisher", "author"),
    "stock_symbols": ("stock_symbols", "tickers", "matched_symbol"),
}
DEFAULT_VOLATILITY = 0.01


def clean_news(news: DataFrame) -> DataFrame:
    """Complete rows with a sentiment in 0..1, plus ``newsDate``."""
    return news.where(
        not_null("newsId", "newsTime", "sentiment") & F.col("sentiment").between(0.0, 1.0)
    ).withColumn("newsDate", news_date(F.col("newsTime")))


def clean_stock(stock: DataFrame) -> DataFrame:
    """Consistent positive prices with a daily return within 10 percent."""
    consistent = (
        "open > 0 AND close > 0 AND volume > 0 "
        "AND high >= open AND high >= close AND low <= open AND low <= close"
    )
    daily_return = F.try_divide(F.col("close") - F.col("open"), F.col("open"))
    return (
        stock.where(consistent)
        .withColumn("dailyReturn", daily_return)
        .where(F.col("dailyReturn").between(-0.1, 0.1))
    )


def resolve_aliases(columns: Sequence[str], aliases: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """target -> the first of its aliases that is a column; absent targets are left out."""
    found = {}
    for target, names in aliases.items():
        name = next((n for n in names if n in columns), None)
        if name is not None:
            found[target] = name
    return found


def rename_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Only the resolved columns, under their target names."""
    found = resolve_aliases(df.columns, aliases)
    return df.select(*[F.col(f"`{name}`").alias(target) for target, name in found.items()])


def clean_quotes(quotes: DataFrame) -> DataFrame:
    """Quotes with a symbol and a numeric price.

    Aliases are looked for only where none of the standard names is there. The
    time column, where present, is kept and must parse; else time and date are NULL. A
    change that is no number is NULL.
    """
    names = [c for c in QUOTE_ALIASES if c in quotes.columns]
    if names:
        named = quotes
    else:
        time_alias = {"created_iso": ("created_iso",)}
        named = rename_aliases(quotes, QUOTE_ALIASES | time_alias)
        names = named.columns
    if "symbol" not in names or "price" not in names:
        raise ValueError("quotes need a symbol and a price column")
    timed = "created_iso" in named.columns
    time = to_timestamp_coerce(F.col("created_iso")) if timed else F.lit(None).cast("timestamp")
    volume = F.col("volume").cast("string") if "volume" in names else F.lit(None).cast("string")
    change = to_numeric_coerce(F.col("change_percent")) if "change_percent" in names else F.lit(0.0)
    cleaned = named.where(not_null("symbol", "price")).select(
        "symbol",
        *(["name"] if "name" in names else []),
        to_numeric_coerce(F.col("price")).alias("price"),
        time.alias("stock_time"),
        F.to_date(time).alias("stock_date"),
        parse_volume(volume).alias("volume_num"),
        change.alias("change_percent"),
    )
    return cleaned.where(not_null("price", *(["stock_time"] if timed else [])))


def clean_articles(articles: DataFrame, default_source: str = "") -> DataFrame:
    """Articles with a time and a known symbol.

    Columns are found by alias; paragraph lists are joined; a missing headline is
    the start of the text; the symbol comes from the symbol column, or from the
    text where there is no such column.
    """
    found = resolve_aliases(articles.columns, ARTICLE_ALIASES)
    if "text_raw" not in found:
        raise ValueError("articles need a text column")
    extra = [c for c in ("post_id", "event_type") if c in articles.columns]
    named = articles.select(*extra, *[F.col(f"`{n}`").alias(t) for t, n in found.items()])
    kinds = {f.name: f.dataType for f in named.schema.fields}

    text = F.col("text_raw")
    if isinstance(kinds["text_raw"], T.ArrayType):
        text = join_paragraphs(text)

    if "created_iso" not in kinds:
        time = F.current_timestamp()
    elif isinstance(kinds["created_iso"], T.NumericType):
        time = F.timestamp_seconds("created_iso")
    else:
        time = to_timestamp_coerce(F.col("created_iso"))

    if "stock_symbols" not in kinds:
        symbol = symbol_from_text(F.col("headline"), F.col("text_raw"))
    elif isinstance(kinds["stock_symbols"], T.ArrayType):
        symbol = first_symbol(F.col("stock_symbols"))
    else:
        blank = F.trim(F.coalesce("stock_symbols", F.lit(""))) == ""
        symbol = F.when(blank, UNKNOWN).otherwise(first_symbol(F.array("stock_symbols")))

    def given(column: str) -> Column:
        return F.col(column) if column in kinds else F.lit(None).cast("string")

    return (
        named.withColumn("text_raw", text)
        .withColumn("news_time", time)
        .where(not_null("news_time"))
        .withColumn("news_date", F.to_date("news_time"))
        .withColumn("headline", headline_fallback(given("headline"), F.col("text_raw")))
        .withColumn("source", F.coalesce(given("source"), F.lit(default_source)))
        .withColumn("matched_symbol", symbol)
        .where(F.col("matched_symbol") != UNKNOWN)
    )


def with_returns(quotes: DataFrame) -> DataFrame:
    """Adds daily_return, total_volume and price_volatility where they are missing."""
    volume = F.col("volume_num") if "volume_num" in quotes.columns else F.lit(0.0)
    missing = {
        "daily_return": F.col("change_percent") / 100,
        "total_volume": volume,
        "price_volatility": F.lit(DEFAULT_VOLATILITY),
    }
    return quotes.withColumns({k: v for k, v in missing.items() if k not in quotes.columns})


def stock_trend(stock: DataFrame, stock_code: str) -> DataFrame:
    return (
        stock.where(F.col("stockCode") == stock_code)
        .select("date", "open", "close", "volume")
        .orderBy("date")
    )


def pe_positive(quotes: DataFrame) -> DataFrame:
    return quotes.where("pe_ratio > 0")
