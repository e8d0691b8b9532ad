"""Writers for rows, summaries and result tables. Paths are on the shared file system."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.operators.ranking import top_movers
from quotewire.operators.summaries import (
    extreme_articles,
    news_summary,
    sentiment_summary,
    stock_summary,
    ticker_mentions,
)
from quotewire.session import materialize


# Quotes in a cell are doubled, as spreadsheets and data frame libraries expect.
DOUBLED_QUOTES = {"escape": '"'}


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    """Headered CSV, replacing what is there."""
    df.write.mode("overwrite").option("header", True).options(**options).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines with NULL fields kept, replacing what is there."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_stocks(quotes: DataFrame, folder: str) -> None:
    """Quotes as JSON and CSV, their summary and the top movers, of quotes computed once."""
    quotes = materialize(quotes)
    write_json(quotes, f"{folder}/stocks_json")
    write_csv(quotes, f"{folder}/stocks_csv", **DOUBLED_QUOTES)
    write_json(stock_summary(quotes), f"{folder}/stock_summary")
    write_json(top_movers(quotes), f"{folder}/top_movers")


def write_news(posts: DataFrame, chunks: DataFrame, folder: str) -> None:
    """Posts, chunks, their summary and the most mentioned symbols, of posts computed once."""
    posts = materialize(posts)
    write_json(posts, f"{folder}/posts")
    write_json(chunks, f"{folder}/chunks")
    write_json(news_summary(posts), f"{folder}/news_summary")
    write_json(ticker_mentions(posts), f"{folder}/ticker_mentions")


def write_sentiment(scored: DataFrame, folder: str) -> None:
    """Scored articles, their summary and the two extreme articles, scored once."""
    scored = materialize(scored)
    write_json(scored, f"{folder}/scored")
    write_json(sentiment_summary(scored), f"{folder}/sentiment_summary")
    write_json(extreme_articles(scored), f"{folder}/extreme_articles")


def write_analysis(pairs: DataFrame, sections: Mapping[str, DataFrame], folder: str) -> None:
    """Pairs and every section of the correlation document."""
    write_json(pairs, f"{folder}/integrated")
    for name, df in sections.items():
        write_json(df, f"{folder}/correlations/{name}")


def write_result_tables(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """One CSV folder per non-empty table; returns the names written."""
    written = []
    for name, df in tables.items():
        if not df.isEmpty():
            write_csv(flat(df), f"{folder}/{name}", **DOUBLED_QUOTES)
            written.append(name)
    return written


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which is what a CSV cell can hold."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[
        (F.to_json(f"`{f.name}`") if isinstance(f.dataType, nested) else F.col(f"`{f.name}`"))
        .alias(f.name)
        for f in df.schema.fields
    ])


def show_df(df: DataFrame, title: str, limit: int = 5) -> None:
    print(f"\n=== {title} ===")
    df.show(limit, truncate=False)
