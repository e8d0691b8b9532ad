"""Queries of cleaning, summaries, joins, series, rankings and chart feeds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewire.operators import (
    cleaning,
    feeds,
    joins,
    ranking,
    sentiment,
    stats,
    summaries,
    timeseries,
)
from quotewire.plans.catalog import query, rounded
from quotewire.plans.inputs import NEGATIVE, POSITIVE, SCORE_SQL, Inputs, sql
from quotewire.plans.scalar_queries import FROM_TEXT_SQL, units_sql, volume_sql

_NEWS_TIME = "strftime(newsTime, '%Y-%m-%d %H:%M:%S') AS newsTime"


def _news(t: Inputs) -> DataFrame:
    return cleaning.clean_news(t.news())


def _stock(t: Inputs) -> DataFrame:
    return cleaning.clean_stock(t.stock())


def _scored(t: Inputs) -> DataFrame:
    return sentiment.score_articles(t.posts(), sentiment.lexicon_scorer(POSITIVE, NEGATIVE))


def _series(t: Inputs, volume: bool = True) -> DataFrame:
    return timeseries.time_series_features(t.pairs("S"), volume)


# --- news and prices ------------------------------------------------------------------


@query(
    "read_news", sql(rounded(f"SELECT * REPLACE ({_NEWS_TIME}) FROM news", "sentiment"), "news")
)
def read_news(t: Inputs) -> DataFrame:
    return t.news()


@query(
    "clean_news",
    sql(rounded(f"SELECT * REPLACE ({_NEWS_TIME}) FROM clean_news", "sentiment"), "clean_news"),
)
def clean_news(t: Inputs) -> DataFrame:
    return _news(t)


@query(
    "clean_stock",
    sql(
        rounded("SELECT * FROM clean_stock", "open", "high", "low", "close", "dailyReturn"),
        "clean_stock",
    ),
)
def clean_stock(t: Inputs) -> DataFrame:
    return _stock(t)


@query("daily_news", sql(rounded("SELECT * FROM daily_news", "dailyAvgSentiment"), "daily_news"))
def daily_news(t: Inputs) -> DataFrame:
    return summaries.daily_news(_news(t))


@query("daily_stock", sql(rounded("SELECT * FROM daily_stock", "dailyAvgReturn"), "daily_stock"))
def daily_stock(t: Inputs) -> DataFrame:
    return summaries.daily_stock(_stock(t))


@query(
    "join_by_date",
    sql(rounded("SELECT * FROM joined", "dailyAvgSentiment", "dailyAvgReturn"), "joined"),
)
def join_by_date(t: Inputs) -> DataFrame:
    return joins.join_by_date(_news(t), _stock(t))


SENTIMENT_VS_RETURN = """
    SELECT CASE WHEN dailyAvgSentiment >= 0.6 THEN 'Positive'
            WHEN dailyAvgSentiment <= 0.4 THEN 'Negative' ELSE 'Neutral' END AS "sentimentType",
        avg(dailyAvgReturn) * 100 AS "avgReturn(%)", count(date) AS "dayCount"
    FROM joined GROUP BY 1"""


@query("sentiment_vs_return", sql(rounded(SENTIMENT_VS_RETURN, "avgReturn(%)"), "joined"))
def sentiment_vs_return(t: Inputs) -> DataFrame:
    return summaries.sentiment_vs_return(joins.join_by_date(_news(t), _stock(t)))


SENTIMENT_DIST = """
    SELECT CASE WHEN sentiment <= 0.3 THEN 'Negative' WHEN sentiment <= 0.7 THEN 'Neutral'
            ELSE 'Positive' END AS "sentimentLevel", count(newsId) AS "count",
        count(newsId) / (SELECT count(*) FROM clean_news) * 100 AS "percentage(%)"
    FROM clean_news GROUP BY 1"""


@query("sentiment_dist", sql(rounded(SENTIMENT_DIST, "percentage(%)"), "clean_news"))
def sentiment_dist(t: Inputs) -> DataFrame:
    return summaries.sentiment_dist(_news(t))


TOP_SOURCES = """
    SELECT newsSource, count(newsId) AS "articleCount" FROM clean_news
    GROUP BY newsSource ORDER BY 2 DESC, 1 LIMIT 10"""


@query("top_sources", sql(TOP_SOURCES, "clean_news"))
def top_sources(t: Inputs) -> DataFrame:
    return summaries.top_sources(_news(t))


RETURN_STATS = """
    SELECT avg(dailyReturn) * 100 AS "avgReturn(%)", stddev_samp(dailyReturn) * 100 AS "stdReturn(%)",
        max(dailyReturn) * 100 AS "maxReturn(%)", min(dailyReturn) * 100 AS "minReturn(%)"
    FROM clean_stock"""
_RETURN_STATS_COLUMNS = ("avgReturn(%)", "stdReturn(%)", "maxReturn(%)", "minReturn(%)")


@query("return_stats", sql(rounded(RETURN_STATS, *_RETURN_STATS_COLUMNS), "clean_stock"))
def return_stats(t: Inputs) -> DataFrame:
    return summaries.return_stats(_stock(t))


@query(
    "stock_trend",
    sql(
        rounded(
            "SELECT date, open, close, volume FROM clean_stock WHERE stockCode = 'S7'",
            "open", "close",
        ),
        "clean_stock",
    ),
)
def stock_trend(t: Inputs) -> DataFrame:
    return cleaning.stock_trend(_stock(t), "S7")


# --- quotes and articles --------------------------------------------------------------

_ALIASED_SQL = f"""
    SELECT symbol, name, price, volume_num, change_percent, stock_time, substr(stock_time, 1, 10) AS stock_date
    FROM (SELECT CASE WHEN part_no % 50 <> 0 THEN symbol END AS symbol, name,
        CASE WHEN part_no % 41 <> 0 THEN price END AS price, change_percent,
        {volume_sql('volume')} AS volume_num,
        CASE WHEN part_no % 37 <> 0 THEN '2024-01-02 09:30:00' END AS stock_time FROM part_quotes)
    WHERE symbol IS NOT NULL AND price IS NOT NULL AND stock_time IS NOT NULL"""


def _raw_quotes(t: Inputs) -> DataFrame:
    """Part quotes as a snapshot would hold them: gaps, text prices, a time column."""
    key = F.col("part_no")
    return t.part_quotes().select(
        F.when(key % 50 != 0, F.col("symbol")).alias("symbol"),
        F.when(key % 41 == 0, "n/a").otherwise(F.col("price").cast("string")).alias("price"),
        "volume",
        "name",
        "change_percent",
        F.when(key % 37 == 0, "soon").otherwise("2024-01-02T09:30:00").alias("created_iso"),
    )


@query("clean_quotes", sql(rounded(_ALIASED_SQL, "price", "change_percent"), "part_quotes"))
def clean_quotes(t: Inputs) -> DataFrame:
    return cleaning.clean_quotes(_raw_quotes(t))


@query("resolve_aliases", sql(rounded(_ALIASED_SQL, "price", "change_percent"), "part_quotes"))
def resolve_aliases(t: Inputs) -> DataFrame:
    other = {
        "symbol": "ticker", "price": "regularMarketPrice", "volume": "dayvolume",
        "name": "companyname", "change_percent": "percentchange",
    }
    return cleaning.clean_quotes(_raw_quotes(t).withColumnsRenamed(other))


_CLEAN_ARTICLES = """
    SELECT post_id, text_raw, coalesce(headline, substr(text_raw, 1, 100)) AS headline, created_iso,
        source, array_to_string(stock_symbols, ',') AS stock_symbols,
        replace(substr(created_iso, 1, 19), 'T', ' ') AS news_time,
        substr(created_iso, 1, 10) AS news_date,
        upper(split_part(stock_symbols[1], '-', 1)) AS matched_symbol
    FROM posts WHERE len(stock_symbols) > 0"""


@query("clean_articles", sql(_CLEAN_ARTICLES, "posts"))
def clean_articles(t: Inputs) -> DataFrame:
    return cleaning.clean_articles(t.posts())


@query(
    "clean_articles_by_text",
    sql(
        f"""SELECT * FROM (SELECT post_id, body AS text_raw, headline, 'wire' AS source,
            strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d %H:%M:%S') AS news_time,
            strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d') AS news_date,
            created_utc AS created_iso, {FROM_TEXT_SQL} AS matched_symbol
            FROM (SELECT *, headline || ' ' || body AS whole FROM (
                SELECT post_id, created_utc, body, coalesce(headline, substr(body, 1, 100)) AS headline
                FROM (SELECT *, array_to_string(string_split(text_raw, chr(10)), ' ') AS body FROM posts))))
        WHERE matched_symbol <> 'UNKNOWN'""",
        "posts",
    ),
)
def clean_articles_by_text(t: Inputs) -> DataFrame:
    raw = t.posts().select(
        "post_id", "headline", "created_utc", F.split("text_raw", "\n").alias("body_texts")
    )
    return cleaning.clean_articles(raw, default_source="wire")


@query(
    "with_returns",
    sql(
        rounded(
            f"""SELECT symbol, change_percent, change_percent / 100 AS daily_return,
                {volume_sql('volume')} AS total_volume, 0.01 AS price_volatility FROM part_quotes""",
            "daily_return", "price_volatility",
        ),
        "part_quotes",
    ),
)
def with_returns(t: Inputs) -> DataFrame:
    quotes = t.part_quotes().withColumn("created_iso", F.lit("2024-01-02"))
    return cleaning.with_returns(cleaning.clean_quotes(quotes)).select(
        "symbol", "change_percent", "daily_return", "total_volume", "price_volatility"
    )


@query(
    "pe_positive",
    sql("SELECT symbol, pe_ratio FROM part_quotes WHERE pe_ratio > 0", "part_quotes"),
)
def pe_positive(t: Inputs) -> DataFrame:
    return cleaning.pe_positive(t.part_quotes()).select("symbol", "pe_ratio")


@query(
    "stock_summary",
    sql(
        rounded(
            """SELECT count(*) AS total_stocks, avg(price) AS average_price,
                avg(change_percent) AS average_change_percent,
                count(*) FILTER (WHERE change_percent > 0) AS positive_changes,
                count(*) FILTER (WHERE change_percent < 0) AS negative_changes FROM part_quotes""",
            "average_price", "average_change_percent",
        ),
        "part_quotes",
    ),
)
def stock_summary(t: Inputs) -> DataFrame:
    return summaries.stock_summary(t.part_quotes())


NEWS_SUMMARY = """
    SELECT count(*) AS total_articles,
        count(*) FILTER (WHERE len(stock_symbols) > 0) AS articles_with_stock_symbols,
        CAST(sum(len(stock_symbols)) AS BIGINT) AS total_stock_mentions,
        (SELECT count(DISTINCT ticker) FROM mentions) AS unique_tickers FROM posts"""


@query("news_summary", sql(NEWS_SUMMARY, "mentions"))
def news_summary(t: Inputs) -> DataFrame:
    return summaries.news_summary(t.posts())


@query("unique_tickers", sql("SELECT DISTINCT ticker FROM mentions", "mentions"))
def unique_tickers(t: Inputs) -> DataFrame:
    return summaries.unique_tickers(t.posts())


@query(
    "ticker_mentions",
    sql(
        """SELECT ticker, count(*) AS "count" FROM mentions GROUP BY ticker
        ORDER BY 2 DESC, 1 LIMIT 10""",
        "mentions",
    ),
)
def ticker_mentions(t: Inputs) -> DataFrame:
    return summaries.ticker_mentions(t.posts())


# --- sentiment ------------------------------------------------------------------------


@query(
    "score_articles",
    sql(
        rounded("SELECT post_id, sentiment_label, sentiment_score FROM scored", "sentiment_score"),
        "scored",
    ),
)
def score_articles(t: Inputs) -> DataFrame:
    return _scored(t).select("post_id", "sentiment_label", "sentiment_score")


def _share_model():
    """A toy model: share of the letter e, as a compound score."""

    def score(texts: pd.Series) -> pd.DataFrame:
        share = texts.str.count("e") / texts.str.len()
        label = (share >= 0.12).map({True: "positive", False: "negative"})
        return pd.DataFrame({"label": label, "score": share})

    return score


@query(
    "score_articles_model",
    sql(
        rounded(
            """SELECT post_id, CASE WHEN short THEN 'neutral' WHEN share >= 0.12 THEN 'positive'
                    ELSE 'negative' END AS sentiment_label,
                CASE WHEN short THEN 0.0 ELSE round(share, 4) END AS sentiment_score
            FROM (SELECT post_id, length(trim(text_raw)) < 10 AS short,
                (length(text_raw) - length(replace(text_raw, 'e', ''))) / length(text_raw) AS share
                FROM posts)""",
            "sentiment_score",
        ),
        "posts",
    ),
)
def score_articles_model(t: Inputs) -> DataFrame:
    scorer = sentiment.model_scorer(_share_model)
    return sentiment.score_articles(t.posts(), scorer).select(
        "post_id", "sentiment_label", "sentiment_score"
    )


SENTIMENT_SUMMARY = """
    SELECT total AS total_articles, p AS positive_count, n AS negative_count, z AS neutral_count,
        round(p / total * 100, 2) AS positive_percentage,
        round(n / total * 100, 2) AS negative_percentage,
        round(z / total * 100, 2) AS neutral_percentage,
        round(mean, 4) AS average_sentiment_score
    FROM (SELECT count(*) AS total, avg(sentiment_score) AS mean,
        count(*) FILTER (WHERE sentiment_label = 'positive') AS p,
        count(*) FILTER (WHERE sentiment_label = 'negative') AS n,
        count(*) FILTER (WHERE sentiment_label = 'neutral') AS z FROM scored)"""
_SENTIMENT_DOUBLES = (
    "positive_percentage", "negative_percentage", "neutral_percentage", "average_sentiment_score",
)


@query("sentiment_summary", sql(rounded(SENTIMENT_SUMMARY, *_SENTIMENT_DOUBLES), "scored"))
def sentiment_summary(t: Inputs) -> DataFrame:
    return summaries.sentiment_summary(_scored(t))


@query(
    "extreme_articles",
    sql(
        rounded(
            """SELECT * FROM (SELECT 'most_positive' AS extreme, post_id, headline, sentiment_score
                FROM scored ORDER BY sentiment_score DESC, post_id LIMIT 1)
            UNION ALL
            SELECT * FROM (SELECT 'most_negative' AS extreme, post_id, headline, sentiment_score
                FROM scored ORDER BY sentiment_score, post_id LIMIT 1)""",
            "sentiment_score",
        ),
        "scored",
    ),
)
def extreme_articles(t: Inputs) -> DataFrame:
    return summaries.extreme_articles(
        _scored(t).select("post_id", "headline", "sentiment_score")
    )


# --- pairs ----------------------------------------------------------------------------

_PAIR_DOUBLES = ("current_price", "daily_change_percent", "sentiment_score")


def _post_pairs(t: Inputs) -> DataFrame:
    return joins.integrate(t.quotes(), _scored(t)).drop("analysis_timestamp")


@query("integrate", sql(rounded("SELECT * FROM post_pairs", *_PAIR_DOUBLES), "post_pairs"))
def integrate(t: Inputs) -> DataFrame:
    return _post_pairs(t)


@query(
    "integrate_dedupe",
    sql(rounded("SELECT DISTINCT * FROM post_pairs", *_PAIR_DOUBLES), "post_pairs"),
)
def integrate_dedupe(t: Inputs) -> DataFrame:
    return joins.integrate(t.quotes(), _scored(t), dedupe=True).drop("analysis_timestamp")


_GROUP_DOUBLES = ("sentiment_score", "daily_change_percent", "current_price")


def _groups(t: Inputs) -> DataFrame:
    return summaries.symbol_groups(t.pairs())


@query("symbol_groups", sql(rounded("SELECT * FROM groups", *_GROUP_DOUBLES), "groups"))
def symbol_groups(t: Inputs) -> DataFrame:
    return _groups(t)


@query(
    "aligned_positive",
    sql(
        rounded(
            "SELECT * FROM groups WHERE sentiment_score > 0.1 AND daily_change_percent > 0",
            *_GROUP_DOUBLES,
        ),
        "groups",
    ),
)
def aligned_positive(t: Inputs) -> DataFrame:
    return summaries.aligned_positive(_groups(t))


@query(
    "aligned_negative",
    sql(
        rounded(
            "SELECT * FROM groups WHERE sentiment_score < -0.1 AND daily_change_percent < 0",
            *_GROUP_DOUBLES,
        ),
        "groups",
    ),
)
def aligned_negative(t: Inputs) -> DataFrame:
    return summaries.aligned_negative(_groups(t))


@query(
    "aligned_counts",
    sql(
        """SELECT count(*) FILTER (WHERE sentiment_score > 0.1 AND daily_change_percent > 0)
                AS positive_correlations,
            count(*) FILTER (WHERE sentiment_score < -0.1 AND daily_change_percent < 0)
                AS negative_correlations FROM groups""",
        "groups",
    ),
)
def aligned_counts(t: Inputs) -> DataFrame:
    return summaries.aligned_counts(_groups(t))


PAIR_LABEL_COUNTS = """
    SELECT count(*) AS total_stock_news_pairs,
        count(DISTINCT stock_symbol) AS unique_stocks_analyzed,
        count(*) FILTER (WHERE news_sentiment = 'positive') AS positive,
        count(*) FILTER (WHERE news_sentiment = 'negative') AS negative,
        count(*) FILTER (WHERE news_sentiment = 'neutral') AS neutral FROM {0}"""


@query("pair_label_counts", sql(PAIR_LABEL_COUNTS.format("pairs"), "pairs"))
def pair_label_counts(t: Inputs) -> DataFrame:
    return summaries.pair_label_counts(t.pairs())


CORRELATION = """
    SELECT CASE WHEN count(*) <= 1 THEN 0.0 ELSE round(
        covar_pop(sentiment_score, daily_change_percent)
        / nullif(stddev_pop(sentiment_score) * stddev_pop(daily_change_percent), 0), 4) END
        AS overall_correlation FROM groups"""


@query("sentiment_price_corr", sql(rounded(CORRELATION, "overall_correlation"), "groups"))
def sentiment_price_corr(t: Inputs) -> DataFrame:
    return stats.sentiment_price_corr(_groups(t))


@query(
    "top_sentiment_symbols",
    sql(
        rounded(
            """SELECT * FROM (SELECT stock_symbol, stock_name, sentiment_score,
                    daily_change_percent, 'positive' AS side
                FROM groups ORDER BY sentiment_score DESC, stock_symbol LIMIT 5)
            UNION ALL
            SELECT * FROM (SELECT stock_symbol, stock_name, sentiment_score,
                    daily_change_percent, 'negative' AS side
                FROM groups ORDER BY sentiment_score, stock_symbol LIMIT 5)""",
            "sentiment_score", "daily_change_percent",
        ),
        "groups",
    ),
)
def top_sentiment_symbols(t: Inputs) -> DataFrame:
    return ranking.top_sentiment_symbols(_groups(t))


@query(
    "top_performers",
    sql(
        rounded(
            """SELECT stock_symbol, daily_change_percent, sentiment_score, stock_name FROM groups
            ORDER BY daily_change_percent DESC, stock_symbol LIMIT 10""",
            "daily_change_percent", "sentiment_score",
        ),
        "groups",
    ),
)
def top_performers(t: Inputs) -> DataFrame:
    return summaries.top_performers(t.pairs())


TOP_MENTIONED = """
    SELECT stock_symbol, count(*) AS mentions FROM {0}
    GROUP BY stock_symbol ORDER BY 2 DESC, 1 LIMIT 10"""


@query("top_mentioned_stocks", sql(TOP_MENTIONED.format("pairs"), "pairs"))
def top_mentioned_stocks(t: Inputs) -> DataFrame:
    return ranking.top_mentioned_stocks(t.pairs())


CLUSTER_FEATURES = """
    SELECT stock_symbol, avg(sentiment_score) AS sentiment_score,
        avg(daily_change_percent) AS daily_change_percent, count(*) AS news_count,
        avg(current_price) AS current_price FROM pairs GROUP BY stock_symbol"""


@query("cluster_features", sql(rounded(CLUSTER_FEATURES, *_GROUP_DOUBLES), "pairs"))
def cluster_features(t: Inputs) -> DataFrame:
    return summaries.cluster_features(t.pairs())


# --- matched news ---------------------------------------------------------------------


def _article_returns(t: Inputs) -> tuple[DataFrame, DataFrame]:
    quotes = t.quotes().withColumn("created_iso", F.lit("2024-01-02"))
    news = sentiment.with_lexicon_sentiment(
        cleaning.clean_articles(t.posts()), POSITIVE, NEGATIVE
    ).select(
        "post_id", "news_time", "news_date", "source", "matched_symbol",
        "sentiment_label", "sentiment_score",
    )
    return news, cleaning.with_returns(cleaning.clean_quotes(quotes))


def match_sql(join: str, quotes: str = "quotes") -> str:
    """News of the posts matched to quotes, in SQL."""
    return f"""
        SELECT post_id, source, matched_symbol, sentiment_label, sentiment_score,
            news_time, news_date, news_time AS stock_time, news_date AS stock_date,
            matched_symbol AS symbol, coalesce(q.change_percent / 100, 0.0) AS daily_return,
            CASE WHEN q.symbol IS NULL THEN 0.0 ELSE {volume_sql("q.volume")} END AS total_volume,
            CASE WHEN q.symbol IS NOT NULL THEN 0.01 END AS price_volatility
        FROM (SELECT *, upper(split_part(stock_symbols[1], '-', 1)) AS matched_symbol,
                replace(substr(created_iso, 1, 19), 'T', ' ') AS news_time,
                substr(created_iso, 1, 10) AS news_date
            FROM lexicon WHERE len(stock_symbols) > 0) n
        {join} JOIN {quotes} q ON n.matched_symbol = q.symbol"""


_MATCH_DOUBLES = ("sentiment_score", "daily_return", "total_volume")


@query(
    "match_news", sql(rounded(match_sql("INNER"), *_MATCH_DOUBLES), "lexicon", "quotes")
)
def match_news(t: Inputs) -> DataFrame:
    news, quotes = _article_returns(t)
    return joins.match_news(news, quotes, order=["name"])


@query(
    "match_news_or_default",
    sql(
        rounded(match_sql("LEFT", "(SELECT * FROM quotes WHERE symbol = 'X')"), *_MATCH_DOUBLES),
        "lexicon", "quotes",
    ),
)
def match_news_or_default(t: Inputs) -> DataFrame:
    news, quotes = _article_returns(t)
    unknown = quotes.withColumn("symbol", F.concat(F.lit("X"), "symbol"))
    return joins.match_news_or_default(news, unknown, order=["name"])


_NEAR_QUOTES = """
    SELECT 'S' || user_id % 10 AS symbol, ts, min(event_id) AS event_id, arg_min((value - 50) / 1000, event_id) AS daily_return,
        CAST(arg_min(user_id, event_id) AS DOUBLE) AS total_volume
    FROM events GROUP BY 1, 2"""


@query(
    "match_news_within",
    sql(
        rounded(
            f"""SELECT post_id, symbol, news_time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stock_time,
                strftime(ts, '%Y-%m-%d') AS stock_date, daily_return, total_volume FROM (
                SELECT n.*, q.*, row_number() OVER (PARTITION BY post_id
                    ORDER BY abs(epoch_us(ts) - created_utc * 1000000), ts) AS place
                FROM (SELECT post_id, created_utc, upper(split_part(stock_symbols[1], '-', 1)) AS symbol,
                        replace(substr(created_iso, 1, 19), 'T', ' ') AS news_time
                    FROM lexicon WHERE len(stock_symbols) > 0) n
                JOIN ({_NEAR_QUOTES}) q USING (symbol)
                WHERE abs(epoch_us(ts) - created_utc * 1000000) <= 5400000000)
            WHERE place = 1""",
            "daily_return", "total_volume",
        ),
        "lexicon",
    ),
)
def match_news_within(t: Inputs) -> DataFrame:
    """The nearest event of a symbol within an hour and a half of its news."""
    news, _ = _article_returns(t)
    quotes = t.matched().select(
        F.concat(F.lit("s"), F.col("total_volume").cast("long") % 10).alias("symbol"),
        F.col("news_time").alias("stock_time"), F.col("news_id").cast("long").alias("event_id"),
        "daily_return", "total_volume", F.lit(0.01).alias("price_volatility"),
    )
    found = joins.match_news_within(news, quotes, ["event_id"], "90 minutes")
    return found.select(
        "post_id", "symbol", "news_time", "stock_time", "stock_date", "daily_return", "total_volume"
    )


SENTIMENT_RETURN = """
    SELECT sentiment_label, avg(daily_return) AS avg_return,
        stddev_samp(daily_return) AS return_std, count(daily_return) AS sample_count
    FROM matched GROUP BY 1"""


@query("sentiment_return", sql(rounded(SENTIMENT_RETURN, "avg_return", "return_std"), "matched"))
def sentiment_return(t: Inputs) -> DataFrame:
    return summaries.sentiment_return(t.matched())


@query(
    "event_impact",
    sql(
        rounded(
            """SELECT event_type, avg(abs(daily_return)) AS avg_abs_return,
                stddev_samp(daily_return) AS volatility, count(daily_return) AS sample_count
            FROM matched GROUP BY 1""",
            "avg_abs_return", "volatility",
        ),
        "matched",
    ),
)
def event_impact(t: Inputs) -> DataFrame:
    return summaries.event_impact(t.matched())


NEWS_VOLUME = """
    SELECT symbol, news_date, daily_news_count, total_volume, daily_return
    FROM (SELECT symbol, news_date, count(*) AS daily_news_count FROM matched GROUP BY ALL)
    JOIN (SELECT DISTINCT symbol, news_date, total_volume, daily_return FROM matched)
        USING (symbol, news_date)"""


@query("news_volume", sql(rounded(NEWS_VOLUME, "total_volume", "daily_return"), "matched"))
def news_volume(t: Inputs) -> DataFrame:
    return summaries.news_volume(t.matched())


SOURCE_IMPACT = """
    SELECT source, avg(abs(daily_return)) AS avg_abs_return,
        avg(sentiment_score) AS avg_sentiment, count(daily_return) AS news_count
    FROM matched GROUP BY source HAVING count(daily_return) >= 2"""


@query("source_impact", sql(rounded(SOURCE_IMPACT, "avg_abs_return", "avg_sentiment"), "matched"))
def source_impact(t: Inputs) -> DataFrame:
    return summaries.source_impact(t.matched())


@query(
    "top_source_impact",
    sql(
        rounded(
            SOURCE_IMPACT + " ORDER BY avg_abs_return DESC, source LIMIT 5",
            "avg_abs_return", "avg_sentiment",
        ),
        "matched",
    ),
)
def top_source_impact(t: Inputs) -> DataFrame:
    return summaries.source_impact(t.matched()).limit(5)


TIME_PERIOD_IMPACT = """
    SELECT CASE WHEN hour(news_time) BETWEEN 9 AND 15 THEN 'TRADING_HOUR'
            WHEN hour(news_time) >= 16 THEN 'AFTER_MARKET' ELSE 'PRE_MARKET' END AS time_period,
        avg(abs(daily_return)) AS avg_abs_return, avg(sentiment_score) AS avg_sentiment,
        count(daily_return) AS sample_count FROM matched GROUP BY 1"""


@query(
    "time_period_impact",
    sql(rounded(TIME_PERIOD_IMPACT, "avg_abs_return", "avg_sentiment"), "matched"),
)
def time_period_impact(t: Inputs) -> DataFrame:
    return summaries.time_period_impact(t.matched())


SYMBOL_IMPACT = """
    SELECT symbol, avg(sentiment_score) AS avg_sentiment, avg(daily_return) AS avg_return,
        count(daily_return) AS sample_count FROM matched GROUP BY symbol"""


@query("symbol_impact", sql(rounded(SYMBOL_IMPACT, "avg_sentiment", "avg_return"), "matched"))
def symbol_impact(t: Inputs) -> DataFrame:
    return summaries.symbol_impact(t.matched())


@query(
    "symbol_news_volume",
    sql(
        rounded(
            """SELECT symbol, count(symbol) AS news_count, avg(total_volume) AS avg_volume
            FROM matched GROUP BY symbol""",
            "avg_volume",
        ),
        "matched",
    ),
)
def symbol_news_volume(t: Inputs) -> DataFrame:
    return summaries.symbol_news_volume(t.matched())


IMPACT_GAP = """
    SELECT coalesce(avg(daily_return) FILTER (WHERE sentiment_label = 'POSITIVE'), 0)
        - coalesce(avg(daily_return) FILTER (WHERE sentiment_label = 'NEGATIVE'), 0)
        AS overall_sentiment_impact FROM matched"""


@query("sentiment_impact_gap", sql(rounded(IMPACT_GAP, "overall_sentiment_impact"), "matched"))
def sentiment_impact_gap(t: Inputs) -> DataFrame:
    return summaries.sentiment_impact_gap(t.matched())


# --- daily series ---------------------------------------------------------------------

_DAILY_DOUBLES = ("sentiment_score", "daily_change_percent", "current_price")
_LAG_DOUBLES = tuple(f"sentiment_lag_{k}" for k in timeseries.SENTIMENT_LAGS)
_CHANGE_DOUBLES = tuple(f"price_change_{k}d" for k in timeseries.PRICE_STEPS)


@query("daily_symbol", sql(rounded("SELECT * FROM daily", *_DAILY_DOUBLES), "daily"))
def daily_symbol(t: Inputs) -> DataFrame:
    return timeseries.daily_symbol(t.pairs("S"))


@query(
    "sentiment_lags",
    sql(
        rounded(
            f"SELECT stock_symbol, date, {', '.join(_LAG_DOUBLES)} FROM changes", *_LAG_DOUBLES
        ),
        "changes",
    ),
)
def sentiment_lags(t: Inputs) -> DataFrame:
    daily = timeseries.sentiment_lags(timeseries.daily_symbol(t.pairs("S")))
    return daily.select("stock_symbol", "date", *_LAG_DOUBLES)


@query(
    "price_changes",
    sql(
        rounded(
            f"SELECT stock_symbol, date, {', '.join(_CHANGE_DOUBLES)} FROM changes", *_CHANGE_DOUBLES
        ),
        "changes",
    ),
)
def price_changes(t: Inputs) -> DataFrame:
    daily = timeseries.price_changes(timeseries.daily_symbol(t.pairs("S")))
    return daily.select("stock_symbol", "date", *_CHANGE_DOUBLES)


@query(
    "rolling_volatility",
    sql(
        rounded("SELECT stock_symbol, date, volatility_5d FROM volatile", "volatility_5d"), "volatile"
    ),
)
def rolling_volatility(t: Inputs) -> DataFrame:
    daily = timeseries.price_changes(timeseries.daily_symbol(t.pairs("S")))
    return timeseries.rolling_volatility(daily).select("stock_symbol", "date", "volatility_5d")


@query(
    "time_series_features",
    sql(
        rounded(
            "SELECT * FROM series", *_DAILY_DOUBLES, *_LAG_DOUBLES, *_CHANGE_DOUBLES, "volatility_5d"
        ),
        "series",
    ),
)
def time_series_features(t: Inputs) -> DataFrame:
    return _series(t)


@query(
    "market_daily",
    sql(
        rounded(
            """SELECT date, avg(sentiment_score) AS sentiment_score,
                avg(price_change_1d) AS price_change_1d,
                CAST(sum(news_count) AS BIGINT) AS news_count FROM series
            WHERE (SELECT count(DISTINCT date) FROM series) >= 5 GROUP BY date""",
            "sentiment_score", "price_change_1d",
        ),
        "series",
    ),
)
def market_daily(t: Inputs) -> DataFrame:
    return timeseries.market_daily(_series(t, volume=False))


@query(
    "symbol_recent",
    sql(
        rounded(
            """SELECT date, current_price, sentiment_score, abs(sentiment_score) > 0.3
                AS strong_sentiment FROM series WHERE stock_symbol = 'S7'
                AND (SELECT count(*) FROM series WHERE stock_symbol = 'S7') >= 5
            ORDER BY date DESC LIMIT 30""",
            "current_price", "sentiment_score",
        ),
        "series",
    ),
)
def symbol_recent(t: Inputs) -> DataFrame:
    recent = timeseries.symbol_recent(_series(t, volume=False), "S7")
    return recent.select("date", "current_price", "sentiment_score", "strong_sentiment")


# Part types as symbols, so that more than one sector occurs.
_SECTOR_PAIRS = f"""
    SELECT CASE WHEN contains(p_type, 'C') THEN 'Finance' ELSE 'Other' END AS sector,
        strftime(l_shipdate, '%Y-%m-%d') AS date, avg({SCORE_SQL}) AS sentiment_score
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""


def _type_pairs(t: Inputs) -> DataFrame:
    types = t.table("part").select(
        F.concat(F.lit("P"), "p_partkey").alias("stock_symbol"), "p_type"
    )
    return t.pairs().join(types, "stock_symbol").withColumn("stock_symbol", F.col("p_type"))


@query("sector_daily", rounded(_SECTOR_PAIRS, "sentiment_score"))
def sector_daily(t: Inputs) -> DataFrame:
    return timeseries.sector_daily(_type_pairs(t))


_HEATMAP_DATES = ("1997-03-01", "1998-07-15", "1999-11-30", "2000-02-29")
_HEATMAP_COLUMNS = ", ".join(
    f"""max(sentiment_score) FILTER (WHERE date = '{d}') AS "{d}" """ for d in _HEATMAP_DATES
)


@query(
    "sector_heatmap",
    rounded(
        f"SELECT sector, {_HEATMAP_COLUMNS} FROM ({_SECTOR_PAIRS}) GROUP BY sector", *_HEATMAP_DATES
    ),
)
def sector_heatmap(t: Inputs) -> DataFrame:
    return timeseries.sector_heatmap(_type_pairs(t), _HEATMAP_DATES)


# --- rankings and sets ----------------------------------------------------------------


def movers_sql(n: int) -> str:
    """Largest and smallest changes, in SQL."""
    return f"""
        SELECT * FROM (SELECT symbol, name, change_percent, 'gainer' AS side FROM part_quotes
            ORDER BY change_percent DESC, symbol LIMIT {n})
        UNION ALL
        SELECT * FROM (SELECT symbol, name, change_percent, 'loser' AS side FROM part_quotes
            ORDER BY change_percent, symbol LIMIT {n})"""


@query("top_movers", sql(movers_sql(5), "part_quotes"))
def top_movers(t: Inputs) -> DataFrame:
    return ranking.top_movers(t.part_quotes())


@query("movers_chart", sql(movers_sql(3), "part_quotes"))
def movers_chart(t: Inputs) -> DataFrame:
    return feeds.movers_chart(t.part_quotes())


@query(
    "limit_per_group",
    sql(
        """SELECT source, post_id FROM (SELECT source, post_id, row_number() OVER (
            PARTITION BY source ORDER BY created_utc, post_id) AS place FROM posts)
        WHERE place <= 3""",
        "posts",
    ),
)
def limit_per_group(t: Inputs) -> DataFrame:
    posts = t.posts().select("source", "created_utc", "post_id")
    return ranking.limit_per_group(posts, "source", ["created_utc", "post_id"], 3).drop("created_utc")


@query(
    "limit_total",
    sql("SELECT post_id FROM posts ORDER BY created_utc, post_id LIMIT 50", "posts"),
)
def limit_total(t: Inputs) -> DataFrame:
    posts = t.posts().select("created_utc", "post_id")
    return ranking.limit_total(posts, ["created_utc", "post_id"], 50).drop("created_utc")


@query(
    "first_per_symbol",
    sql(
        rounded(
            """SELECT stockCode, first.date AS date, first.close AS close, first.volume AS volume
            FROM (SELECT stockCode, arg_min(ROW(date, close, volume)::STRUCT(date VARCHAR, close DOUBLE,
                volume BIGINT), ROW(date, close, volume)) AS first FROM clean_stock GROUP BY stockCode)""",
            "close",
        ),
        "clean_stock",
    ),
)
def first_per_symbol(t: Inputs) -> DataFrame:
    stock = _stock(t).select("stockCode", "date", "close", "volume")
    return ranking.first_per_symbol(stock, ["date", "close", "volume"], key="stockCode")


def _batches(t: Inputs) -> DataFrame:
    """Order lines as crawl batches: the lines of one order priority by ship day."""
    return t.pairs().select(
        F.col("published_at").alias("batch"), F.col("stock_symbol").alias("symbol"),
        F.col("current_price").alias("price"), "news_id",
    )


@query(
    "dedup_symbols",
    sql(
        rounded(
            """SELECT batch, symbol, price, news_id FROM (
                SELECT published_at AS batch, stock_symbol AS symbol, current_price AS price, news_id,
                    row_number() OVER (PARTITION BY published_at, stock_symbol ORDER BY news_id) AS place
                FROM pairs) WHERE place = 1""",
            "price",
        ),
        "pairs",
    ),
)
def dedup_symbols(t: Inputs) -> DataFrame:
    return ranking.dedup_symbols(_batches(t), ["news_id"], batch="batch")


@query(
    "dedup_symbols_all",
    sql(
        rounded(
            """SELECT batch, symbol, price, news_id FROM (
                SELECT published_at AS batch, stock_symbol AS symbol, current_price AS price, news_id,
                    row_number() OVER (PARTITION BY stock_symbol ORDER BY news_id) AS place
                FROM pairs) WHERE place = 1""",
            "price",
        ),
        "pairs",
    ),
)
def dedup_symbols_all(t: Inputs) -> DataFrame:
    return ranking.dedup_symbols(_batches(t), ["news_id"])


@query(
    "union_snapshots",
    sql(
        rounded(
            """SELECT symbol, name, price, pe_ratio, volume FROM part_quotes UNION ALL
            SELECT symbol, name, price, NULL, volume FROM quotes""",
            "price",
        ),
        "part_quotes", "quotes",
    ),
)
def union_snapshots(t: Inputs) -> DataFrame:
    return ranking.union_snapshots(
        t.part_quotes().select("symbol", "name", "price", "pe_ratio", "volume"),
        t.quotes().select("symbol", "name", "price", "volume"),
    )


@query(
    "distinct_rows",
    sql(
        rounded(
            "SELECT DISTINCT symbol, news_date, total_volume, daily_return FROM matched",
            "total_volume", "daily_return",
        ),
        "matched",
    ),
)
def distinct_rows(t: Inputs) -> DataFrame:
    return ranking.distinct_rows(
        t.matched(), ["symbol", "news_date", "total_volume", "daily_return"]
    )


# --- chart feeds ----------------------------------------------------------------------


@query(
    "label_shares",
    sql(
        rounded(
            """SELECT sentiment_label AS label, count(*) AS "count",
                count(*) / (SELECT count(*) FROM scored) AS share FROM scored GROUP BY 1""",
            "share",
        ),
        "scored",
    ),
)
def label_shares(t: Inputs) -> DataFrame:
    return feeds.label_shares(_scored(t))


@query(
    "price_histogram",
    sql(
        rounded(
            """SELECT CAST(b AS BIGINT) AS bin, low + b * width AS lower, low + (b + 1) * width AS upper,
                coalesce(n, 0) AS "count"
            FROM range(20) r(b) CROSS JOIN (
                SELECT min(price) AS low, (max(price) - min(price)) / 20 AS width FROM part_quotes)
            LEFT JOIN (SELECT least(19, floor((price - low) / (high - low) * 20)) AS place, count(*) AS n
                FROM part_quotes, (SELECT min(price) AS low, max(price) AS high FROM part_quotes)
                GROUP BY 1) ON place = b""",
            "lower", "upper",
        ),
        "part_quotes",
    ),
)
def price_histogram(t: Inputs) -> DataFrame:
    return feeds.price_histogram(t.part_quotes())


@query(
    "pe_box",
    sql(
        rounded(
            """SELECT count(*) AS n, min(pe_ratio) AS minimum, quantile_cont(pe_ratio, 0.25) AS q1,
                quantile_cont(pe_ratio, 0.5) AS median, quantile_cont(pe_ratio, 0.75) AS q3,
                max(pe_ratio) AS maximum FROM part_quotes WHERE pe_ratio > 0""",
            "minimum", "q1", "median", "q3", "maximum",
        ),
        "part_quotes",
    ),
)
def pe_box(t: Inputs) -> DataFrame:
    return feeds.pe_box(t.part_quotes())


@query(
    "return_box",
    sql(
        rounded(
            """SELECT sentiment_label, count(*) AS n, min(daily_return) AS minimum,
                quantile_cont(daily_return, 0.25) AS q1, quantile_cont(daily_return, 0.5) AS median,
                quantile_cont(daily_return, 0.75) AS q3, max(daily_return) AS maximum
            FROM matched GROUP BY 1""",
            "minimum", "q1", "median", "q3", "maximum",
        ),
        "matched",
    ),
)
def return_box(t: Inputs) -> DataFrame:
    return feeds.return_box(t.matched())


@query(
    "cap_vs_volume",
    sql(
        rounded(
            f"""SELECT symbol, coalesce({units_sql("volume")}, 0.0) AS volume, coalesce(
                {units_sql("market_cap")}, 0.0) AS market_cap, change_percent FROM part_quotes""",
            "volume", "market_cap",
        ),
        "part_quotes",
    ),
)
def cap_vs_volume(t: Inputs) -> DataFrame:
    return feeds.cap_vs_volume(t.part_quotes())


@query(
    "sentiment_scatter",
    sql(
        rounded(
            """SELECT news_id, sentiment_score, daily_change_percent, current_price, stock_symbol,
                stock_symbol || '<br>' || substr(news_headline, 1, 50) || '...' AS text FROM pairs""",
            *_PAIR_DOUBLES,
        ),
        "pairs",
    ),
)
def sentiment_scatter(t: Inputs) -> DataFrame:
    return feeds.sentiment_scatter(t.pairs())


@query(
    "trend_line",
    sql(
        rounded(
            """SELECT CAST(p AS BIGINT) AS point, low + p * (high - low) / 99 AS x,
                my + slope * (low + p * (high - low) / 99 - mx) AS y
            FROM range(100) r(p), (SELECT min(sentiment_score) AS low, max(sentiment_score) AS high,
                avg(sentiment_score) AS mx, avg(daily_change_percent) AS my,
                covar_pop(sentiment_score, daily_change_percent) / var_pop(sentiment_score) AS slope
                FROM pairs)""",
            "x", "y",
        ),
        "pairs",
    ),
)
def trend_line(t: Inputs) -> DataFrame:
    return stats.trend_line(t.pairs())


@query(
    "aligned_top",
    sql(
        rounded(
            """SELECT * FROM (SELECT stock_symbol, sentiment_score, 'positive' AS side FROM groups
                WHERE sentiment_score > 0.1 AND daily_change_percent > 0
                ORDER BY sentiment_score DESC, stock_symbol LIMIT 10)
            UNION ALL
            SELECT * FROM (SELECT stock_symbol, sentiment_score, 'negative' AS side FROM groups
                WHERE sentiment_score < -0.1 AND daily_change_percent < 0
                ORDER BY sentiment_score, stock_symbol LIMIT 10)""",
            "sentiment_score",
        ),
        "groups",
    ),
)
def aligned_top(t: Inputs) -> DataFrame:
    return feeds.aligned_top(_groups(t))


RUN_SUMMARY = """
    SELECT (SELECT count(*) FROM quotes) AS stocks_crawled,
        (SELECT count(*) FROM posts) AS news_articles_crawled,
        (SELECT count(*) FROM scored) AS articles_with_sentiment,
        (SELECT count(*) FROM post_pairs) AS stock_news_integrations,
        false AS sentiment_analysis_skipped"""


@query("run_summary", sql(RUN_SUMMARY, "post_pairs"))
def run_summary(t: Inputs) -> DataFrame:
    return summaries.run_summary(t.quotes(), t.posts(), _scored(t), _post_pairs(t))


_DIGEST_STOCKS = """
    SELECT count(*) AS total_stocks, avg(price) AS average_price,
        avg(change_percent) AS average_change_percent,
        count(*) FILTER (WHERE change_percent > 0) AS positive_changes,
        count(*) FILTER (WHERE change_percent < 0) AS negative_changes FROM quotes"""
_DIGEST_CORRELATION = CORRELATION.replace(
    "FROM groups",
    """FROM (SELECT avg(sentiment_score) AS sentiment_score,
        avg(daily_change_percent) AS daily_change_percent FROM post_pairs GROUP BY stock_symbol)""",
)


@query(
    "daily_digest",
    sql(
        rounded(
            f"""SELECT r.*, s.*, n.*, z.* RENAME (total_articles AS sentiment_total_articles), c.*
            FROM ({RUN_SUMMARY}) r, ({_DIGEST_STOCKS}) s, ({NEWS_SUMMARY}) n,
                ({SENTIMENT_SUMMARY}) z, ({_DIGEST_CORRELATION}) c""",
            "average_price", "average_change_percent", *_SENTIMENT_DOUBLES, "overall_correlation",
        ),
        "post_pairs", "mentions",
    ),
)
def daily_digest(t: Inputs) -> DataFrame:
    scored, pairs = _scored(t), _post_pairs(t)
    return feeds.daily_digest(
        summaries.run_summary(t.quotes(), t.posts(), scored, pairs),
        summaries.stock_summary(t.quotes()),
        summaries.news_summary(t.posts()),
        summaries.sentiment_summary(scored),
        stats.sentiment_price_corr(summaries.symbol_groups(pairs)),
    )


@query(
    "symbol_topic_edges",
    sql(
        rounded(
            """SELECT src, dst, arg_max(weight, published_at || news_id) AS weight FROM (
                SELECT stock_symbol AS src, published_at, news_id, abs(sentiment_score) AS weight,
                    unnest([CASE WHEN daily_change_percent > 1 AND sentiment_score > 0.2
                            THEN 'positive_performer'
                        WHEN daily_change_percent < -1 AND sentiment_score < -0.2
                            THEN 'negative_performer' END,
                        CASE WHEN sentiment_score > 0.5 THEN 'high_sentiment'
                        WHEN sentiment_score < -0.5 THEN 'low_sentiment' END]) AS dst
                FROM pairs) WHERE dst IS NOT NULL GROUP BY src, dst""",
            "weight",
        ),
        "pairs",
    ),
)
def symbol_topic_edges(t: Inputs) -> DataFrame:
    return feeds.symbol_topic_edges(t.pairs())


@query(
    "graph_nodes",
    sql(
        """SELECT DISTINCT stock_symbol AS node, 'stock' AS type FROM pairs UNION ALL
        SELECT unnest(['positive_performer', 'negative_performer', 'neutral_performer',
            'high_sentiment', 'low_sentiment']), 'topic'""",
        "pairs",
    ),
)
def graph_nodes(t: Inputs) -> DataFrame:
    return feeds.graph_nodes(t.pairs())
