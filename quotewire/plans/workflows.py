"""The analyses a user runs as a whole, as named lazy DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewire.functions.labels import NEGATIVE_WORDS, POSITIVE_WORDS
from quotewire.operators import causality, clusters, cubes, feeds, models, ranking, stats, summaries, timeseries
from quotewire.operators.cleaning import (
    clean_articles,
    clean_news,
    clean_quotes,
    clean_stock,
    with_returns,
)
from quotewire.operators.joins import integrate, match_news_or_default
from quotewire.operators.sentiment import (
    Scorer,
    score_articles,
    with_lexicon_sentiment,
)
from quotewire.session import materialize, reread

Tables = dict[str, DataFrame]


def full_workflow(news: DataFrame, stock: DataFrame, stock_code: str, n_sources: int = 10) -> Tables:
    """Clean news and prices, join them by date, and the five analyses of them.

    Each input is read once: its grouped tables are written as one cube, far smaller than
    the input, and selected from there.
    """
    news = materialize(cubes.news_cube(clean_news(news)))
    stock = materialize(cubes.stock_cube(clean_stock(stock), stock_code))
    joined = cubes.daily_news(news).join(cubes.daily_stock(stock), "date")
    return {
        "joined": joined,
        "top_sources": cubes.top_sources(news, n_sources),
        "sentiment_dist": cubes.sentiment_dist(news),
        "return_stats": cubes.return_stats(stock),
        "stock_trend": cubes.stock_trend(stock),
        "sentiment_vs_return": summaries.sentiment_vs_return(joined),
    }


def simple_news(news: DataFrame) -> DataFrame:
    return summaries.sentiment_dist(clean_news(news))


def correlation_sections(pairs: DataFrame) -> Tables:
    """The sections of the correlation analysis of pairs."""
    groups = summaries.symbol_groups(pairs)
    return {
        "overall_correlation": stats.sentiment_price_corr(groups),
        "pair_label_counts": summaries.pair_label_counts(pairs),
        "aligned_counts": summaries.aligned_counts(groups),
        "aligned_positive": summaries.aligned_positive(groups),
        "aligned_negative": summaries.aligned_negative(groups),
        "top_sentiment_symbols": ranking.top_sentiment_symbols(groups),
    }


def base_workflow(
    quotes: DataFrame,
    posts: DataFrame,
    scorer: Scorer | None = None,
    skip_sentiment: bool = False,
    quote_order: Sequence[str] = ("timestamp",),
) -> Tables:
    """Score posts, pair them with quotes, correlate, and the chart feeds and summaries.

    With ``skip_sentiment`` posts count as neutral 0.0. Scored posts and pairs feed many
    tables, so each is worked out once and written to the shared folder.
    """
    scored = None if skip_sentiment else materialize(score_articles(posts, scorer))
    pairs = materialize(integrate(quotes, posts if scored is None else scored, quote_order))
    sections = correlation_sections(pairs)
    groups = summaries.symbol_groups(pairs)
    # One row each, which also hold the sizes that the summary of the run wants.
    stocks = materialize(summaries.stock_summary(quotes))
    news = materialize(summaries.news_summary(posts))
    sections["pair_label_counts"] = materialize(sections["pair_label_counts"])
    moods = None if scored is None else materialize(summaries.sentiment_summary(scored))
    run = summaries.run_summary_of(stocks, news, moods, sections["pair_label_counts"])
    tables = {
        "pairs": pairs,
        **sections,
        "stock_summary": stocks,
        "top_movers": ranking.top_movers(quotes),
        "news_summary": news,
        "ticker_mentions": summaries.ticker_mentions(posts),
        "price_histogram": feeds.price_histogram(quotes),
        "sentiment_scatter": feeds.sentiment_scatter(pairs),
        "trend_line": stats.trend_line(pairs),
        "aligned_top": feeds.aligned_top(groups),
        "top_performers": summaries.top_performers(pairs),
        "top_mentioned_stocks": ranking.top_mentioned_stocks(pairs),
        "run_summary": run,
    }
    if scored is not None:
        tables["scored"] = scored
        tables["sentiment_summary"] = moods
        tables["extreme_articles"] = summaries.extreme_articles(scored)
        tables["label_shares"] = feeds.label_shares(scored)
        tables["daily_digest"] = feeds.daily_digest(
            run, stocks, news, moods, tables["overall_correlation"],
        )
    return tables


@dataclass(frozen=True)
class Research:
    """Tables of a research run and its fitted models (None: too little data)."""

    tables: Tables = field(default_factory=dict)
    forests: models.ForestModels | None = None


#: What the tables of a research run read of pairs; headlines and addresses are not copied.
RESEARCH_COLUMNS = (
    *summaries.PAIR_ORDER, "stock_symbol", "stock_name", "current_price", "daily_change_percent",
    "market_cap", "volume", "news_sentiment", "sentiment_score",
)


def research_workflow(pairs: DataFrame, trees: int = models.TREES) -> Research:
    """Time series, Granger tests, forests, clusters, sectors, graph and report.

    ``pairs`` is read by many jobs, so what they read of it is written to the shared folder
    once, unless it lies in parquet files already. So is the time series, with its split, that
    the models re-read.
    """
    pairs = reread(pairs.select(*RESEARCH_COLUMNS))
    series = timeseries.time_series_features(pairs)
    written = materialize(series.withColumn("_train", models.in_train()))
    series = written.drop("_train")
    forests = models.build_prediction_models(written, trees, side=F.col("_train"))
    members = materialize(clusters.kmeans_symbols(materialize(summaries.cluster_features(pairs))))
    correlation = stats.sentiment_price_corr(summaries.symbol_groups(pairs))
    tables = {
        "time_series": series,
        "market_daily": timeseries.market_daily(series),
        "top_mentioned_stocks": ranking.top_mentioned_stocks(pairs, 5),
        "granger": causality.granger(series),
        "kmeans_symbols": members,
        "cluster_profile": clusters.cluster_profile(members),
        "sector_daily": timeseries.sector_daily(pairs),
        "symbol_topic_edges": feeds.symbol_topic_edges(pairs),
        "graph_nodes": feeds.graph_nodes(pairs),
        "report_findings": stats.report_findings(
            pairs, correlation, None if forests is None else forests.results
        ),
    }
    if forests is not None:
        tables["model_results"] = forests.results
        tables["feature_importance"] = forests.feature_importance
    return Research(tables, forests)


def matched_tables(matched: DataFrame) -> Tables:
    """The grouped tables of news matched to returns: one pass for all but the volumes."""
    table = materialize(cubes.matched_cube(matched))
    tables = {
        "sentiment_return": cubes.sentiment_return(table),
        "volume_analysis": summaries.news_volume(matched),
        "source_impact": cubes.source_impact(table),
        "time_period_analysis": cubes.time_period_impact(table),
        "symbol_analysis": cubes.symbol_impact(table),
        "sentiment_impact_gap": cubes.sentiment_impact_gap(table),
        "matches": cubes.total_matches(table),
    }
    if "event_type" in matched.columns:
        tables["event_analysis"] = cubes.event_impact(table)
    return tables


def correlation_report(
    articles: DataFrame,
    quotes: DataFrame,
    quote_order: Sequence[str],
    words: Mapping[str, Sequence[str]] | None = None,
) -> Tables:
    """Clean both sides, score by word lists, match by symbol, and the grouped tables.

    ``quote_order`` names columns of the cleaned quotes that decide which quote of a
    symbol is the first. The matched news feeds every table, so it is written to the shared folder once.
    """
    words = words or {"positive": POSITIVE_WORDS, "negative": NEGATIVE_WORDS}
    news = with_lexicon_sentiment(clean_articles(articles), words["positive"], words["negative"])
    returns = with_returns(clean_quotes(quotes))
    matched = materialize(match_news_or_default(news, returns, quote_order))
    tables = matched_tables(matched)
    return {
        "matched": matched,
        **tables,
        "totals": returns.agg(F.count_distinct("symbol").alias("total_stocks_analyzed")).select(
            "total_stocks_analyzed",
            news.agg(F.count("*")).scalar().alias("total_news_articles"),
            tables["matches"].scalar().alias("total_matches"),
        ),
    }
