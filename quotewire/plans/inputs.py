"""Views over the given tables, as Spark frames and as the same views in SQL."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.functions.labels import compound_label
from quotewire.functions.numbers import round_half_up
from quotewire.operators.pages import Site
from quotewire.session import configure
from quotewire.sources.readers import read_news

SITE = Site(
    name="Example Wire",
    platform="example_wire",
    quote_base_url="https://quotes.example.com",
    article_base_url="https://news.example.com",
    quotes_url="https://quotes.example.com/active?start={start}&count={count}",
)

# A lexicon that occurs in the given texts.
POSITIVE = ("able", "ing ", "ouea", "stion", "erea", "ich ")
NEGATIVE = ("nter", "ent", "worth", "heed", "eaux", "und ")

EPOCH_2024 = 1704067200
SCORE_STEP = 5 / 32
SCORE_SQL = f"round((l_discount - 0.05) * 100) * {SCORE_STEP}"


def _cases(number: Column, texts: list[Column | None]) -> Column:
    """The text at place ``number`` modulo the length of the list."""
    out = F.lit(None).cast("string")
    for i, text in enumerate(texts):
        value = F.lit(None).cast("string") if text is None else text
        out = F.when(F.pmod(number, F.lit(len(texts))) == i, value).otherwise(out)
    return out


def _digits(number: Column) -> Column:
    return number.cast("string")


class Inputs:
    """Input frames of one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        """A given table, its times as UTC timestamps."""
        df = self.spark.read.parquet(self.path(name))
        times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in times})

    def news(self) -> DataFrame:
        return read_news(
            self.spark,
            self.path("orders"),
            fields={
                "newsId": "o_orderkey",
                "newsTime": "o_orderdate",
                "newsSource": "o_orderpriority",
                "sentiment": "o_totalprice / 400000.0D",
            },
        )

    def stock(self) -> DataFrame:
        close, off = F.col("close"), F.col("l_discount") - 0.05
        return (
            self.table("lineitem")
            .withColumn("close", F.col("l_extendedprice") / F.col("l_quantity"))
            .select(
                F.concat(F.lit("S"), "l_suppkey").alias("stockCode"),
                F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
                (close * (1 + off * 2.4)).alias("open"),
                (close * (1 + F.col("l_tax") * 2.5)).alias("high"),
                (close * (1 - F.col("l_tax") * 2.5)).alias("low"),
                "close",
                F.col("l_quantity").cast("long").alias("volume"),
            )
        )

    def pairs(self, by: str = "P") -> DataFrame:
        """Pairs keyed by part (P) or, for long daily series, by supplier (S).

        Scores and changes are binary fractions, so their sums do not depend on the order
        of the rows, and a mean that is exactly at a threshold is so in every engine.
        """
        key = F.col("l_partkey") if by == "P" else F.col("l_suppkey")
        day = F.date_format("l_shipdate", "yyyy-MM-dd")
        symbol = F.concat(F.lit(by), key)
        score = round_half_up((F.col("l_discount") - 0.05) * 100) * SCORE_STEP
        return self.table("lineitem").select(
            F.concat_ws(
                "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day
            ).alias("news_id"),
            symbol.alias("stock_symbol"),
            F.concat(F.lit("Stock "), symbol).alias("stock_name"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("current_price"),
            round_half_up((F.col("l_tax") - 0.04) * 100).alias("daily_change_percent"),
            F.concat(F.col("l_linenumber").cast("string"), F.lit("B")).alias("market_cap"),
            F.col("l_quantity").cast("long").cast("string").alias("volume"),
            F.concat(F.lit("Order "), "l_returnflag", "l_linestatus", F.lit(" shipped on "), day)
            .alias("news_headline"),
            compound_label(score).alias("news_sentiment"),
            score.alias("sentiment_score"),
            F.concat(day, F.lit("T00:00:00+00:00")).alias("published_at"),
        )

    def posts(self) -> DataFrame:
        n = F.col("doc_id")
        created = F.lit(EPOCH_2024) + n % 30 * 86400 + n % 24 * 3600
        symbols = F.array(
            F.concat(F.lit("S"), (n % 10).cast("string")),
            F.concat(F.lit("S"), (n % 7).cast("string"), F.lit("-USD")),
        )
        return self.table("documents").select(
            _digits(n).alias("post_id"),
            created.alias("created_utc"),
            F.concat(
                F.date_format(F.timestamp_seconds(created), "yyyy-MM-dd'T'HH:mm:ss"),
                F.lit("+00:00"),
            ).alias("created_iso"),
            F.col("lang").alias("author"),
            F.col("text").alias("text_raw"),
            F.concat(F.lit("https://news.example.com/"), _digits(n)).alias("url"),
            "source",
            F.when(n % 3 != 0, F.substring("text", 1, 60)).alias("headline"),
            F.when(n % 5 == 0, F.array().cast("array<string>")).otherwise(symbols)
            .alias("stock_symbols"),
            F.lit(SITE.quotes_url).alias("most_active_stocks_url"),
        )

    def quotes(self) -> DataFrame:
        """Quotes of the suppliers' symbols, for joins."""
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            F.concat(F.lit("S"), key).alias("symbol"),
            F.col("s_name").alias("name"),
            F.abs("s_acctbal").alias("price"),
            (F.col("s_nationkey") - 12).cast("double").alias("change_percent"),
            F.concat(_digits(key + 1), F.lit("B")).alias("market_cap"),
            F.concat(_digits(key + 1), F.lit("M")).alias("volume"),
            key.alias("timestamp"),
        )

    def part_quotes(self) -> DataFrame:
        """Quotes of the parts, with ties in the change and numbers as text."""
        key = F.col("p_partkey")
        n = _digits(key)
        return self.table("part").select(
            F.concat(F.lit("P"), n).alias("symbol"),
            F.col("p_name").alias("name"),
            F.col("p_retailprice").alias("price"),
            (key % 21 - 10).cast("double").alias("change_percent"),
            (F.col("p_size") - 5).cast("double").alias("pe_ratio"),
            _cases(key, [
                F.concat(F.lit("1,"), F.lpad((key % 1000).cast("string"), 3, "0")),
                F.concat(n, F.lit(".5M")), F.concat(n, F.lit("B")), F.concat(n, F.lit("k")),
                F.lit("--"), F.lit("N/A"), F.lit(""), None,
            ]).alias("volume"),
            _cases(key, [
                F.concat(n, F.lit(".25T")), F.concat(n, F.lit("B")), F.concat(n, F.lit("m")), n,
                F.lit("-"), F.lit("n/a"), F.lit("bad"), None,
            ]).alias("market_cap"),
            key.alias("part_no"),
        )

    def matched(self) -> DataFrame:
        value = F.col("value")
        score = (value - 50) / 100
        return self.table("events").select(
            _digits(F.col("event_id")).alias("news_id"),
            F.concat(F.lit("S"), "user_id").alias("symbol"),
            F.col("ts").alias("news_time"),
            F.to_date("ts").alias("news_date"),
            "event_type",
            F.col("event_type").alias("source"),
            ((value - 50) / 1000).alias("daily_return"),
            score.alias("sentiment_score"),
            F.upper(compound_label(score)).alias("sentiment_label"),
            F.col("user_id").cast("double").alias("total_volume"),
        )

    def number_texts(self) -> DataFrame:
        """Numbers in the ways they are written, and texts that are none."""
        key = F.col("p_partkey")
        n, lit = _digits(key), F.lit
        return self.table("part").select(
            key.alias("part_no"),
            _cases(key, [
                F.concat(lit("$1,"), F.lpad((key % 1000).cast("string"), 3, "0"), lit(".25")),
                F.concat(n, lit(".5%")), F.concat(lit("+"), n), F.concat(lit("-"), n, lit(".75")),
                F.concat(lit(" "), n, lit(" ")), F.concat(n, lit("e2")), F.concat(n, lit("d")),
                lit("N/A"), lit("--"), lit("-"), lit(""), lit("nan"), F.concat(lit("1_"), n),
                F.concat(lit("1 "), n), lit("None"), None, F.concat(n, lit("K")),
                F.concat(lit("$"), n, lit(".5m")),
            ]).alias("raw"),
        )


# The same views in SQL; each names the views it is built on.
_NUMBER_TEXT = {
    "number_texts": """
        SELECT p_partkey AS part_no, CASE p_partkey % 18
            WHEN 0 THEN '$1,' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || '.25'
            WHEN 1 THEN p_partkey || '.5%' WHEN 2 THEN '+' || p_partkey
            WHEN 3 THEN '-' || p_partkey || '.75' WHEN 4 THEN ' ' || p_partkey || ' '
            WHEN 5 THEN p_partkey || 'e2' WHEN 6 THEN p_partkey || 'd' WHEN 7 THEN 'N/A'
            WHEN 8 THEN '--' WHEN 9 THEN '-' WHEN 10 THEN '' WHEN 11 THEN 'nan'
            WHEN 12 THEN '1_' || p_partkey WHEN 13 THEN '1 ' || p_partkey WHEN 14 THEN 'None'
            WHEN 16 THEN p_partkey || 'K' WHEN 17 THEN '$' || p_partkey || '.5m' END AS raw
        FROM part""",
}


def _pairs_sql(by: str, key: str) -> str:
    return f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, day) AS news_id,
            '{by}' || {key} AS stock_symbol, 'Stock {by}' || {key} AS stock_name,
            l_extendedprice / l_quantity AS current_price,
            round((l_tax - 0.04) * 100) AS daily_change_percent,
            l_linenumber || 'B' AS market_cap,
            CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS volume,
            'Order ' || l_returnflag || l_linestatus || ' shipped on ' || day AS news_headline,
            CASE WHEN {SCORE_SQL} >= 0.05 THEN 'positive' WHEN {SCORE_SQL} <= -0.05 THEN 'negative'
                 ELSE 'neutral' END AS news_sentiment, {SCORE_SQL} AS sentiment_score,
            day || 'T00:00:00+00:00' AS published_at
        FROM (SELECT *, strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem)"""


def _words_sql(words: tuple[str, ...]) -> str:
    return " + ".join(f"CAST(contains(lower(text_raw), '{w}') AS INTEGER)" for w in words)


SQL_VIEWS: dict[str, str] = {
    "news": """
        SELECT CAST(o_orderkey AS VARCHAR) AS newsId, o_orderdate AS newsTime,
            o_orderpriority AS newsSource, o_totalprice / 400000.0 AS sentiment FROM orders""",
    "clean_news": """
        SELECT *, strftime(newsTime, '%Y-%m-%d') AS newsDate FROM news
        WHERE newsId IS NOT NULL AND newsTime IS NOT NULL AND sentiment BETWEEN 0 AND 1""",
    "stock": """
        SELECT 'S' || l_suppkey AS stockCode, strftime(l_shipdate, '%Y-%m-%d') AS date,
            close * (1 + (l_discount - 0.05) * 2.4) AS open, close * (1 + l_tax * 2.5) AS high,
            close * (1 - l_tax * 2.5) AS low, close, CAST(l_quantity AS BIGINT) AS volume
        FROM (SELECT *, l_extendedprice / l_quantity AS close FROM lineitem)""",
    "clean_stock": """
        SELECT * FROM (SELECT *, (close - open) / open AS dailyReturn FROM stock
            WHERE open > 0 AND close > 0 AND volume > 0 AND high >= open AND high >= close
              AND low <= open AND low <= close)
        WHERE dailyReturn BETWEEN -0.1 AND 0.1""",
    "daily_news": """
        SELECT newsDate AS date, count(newsId) AS dailyNewsCount, avg(sentiment) AS dailyAvgSentiment
        FROM clean_news GROUP BY newsDate""",
    "daily_stock": """
        SELECT date, avg(dailyReturn) AS dailyAvgReturn,
            CAST(sum(volume) AS BIGINT) AS dailyTotalVolume FROM clean_stock GROUP BY date""",
    "joined": "SELECT * FROM daily_news JOIN daily_stock USING (date)",
    "pairs": _pairs_sql("P", "l_partkey"),
    "spairs": _pairs_sql("S", "l_suppkey"),
    "posts": f"""
        SELECT *, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS created_iso
        FROM (SELECT CAST(doc_id AS VARCHAR) AS post_id,
            {EPOCH_2024} + doc_id % 30 * 86400 + doc_id % 24 * 3600 AS created_utc,
            lang AS author, text AS text_raw, 'https://news.example.com/' || doc_id AS url, source,
            CASE WHEN doc_id % 3 <> 0 THEN substr(text, 1, 60) END AS headline,
            CASE WHEN doc_id % 5 = 0 THEN CAST([] AS VARCHAR[])
                 ELSE ['S' || doc_id % 10, 'S' || doc_id % 7 || '-USD'] END AS stock_symbols,
            '{SITE.quotes_url}' AS most_active_stocks_url
            FROM documents)""",
    "mentions": "SELECT post_id, unnest(stock_symbols) AS ticker FROM posts",
    "quotes": """
        SELECT 'S' || s_suppkey AS symbol, s_name AS name, abs(s_acctbal) AS price,
            CAST(s_nationkey - 12 AS DOUBLE) AS change_percent,
            (s_suppkey + 1) || 'B' AS market_cap, (s_suppkey + 1) || 'M' AS volume FROM supplier""",
    "part_quotes": """
        SELECT 'P' || p_partkey AS symbol, p_name AS name, p_retailprice AS price,
            CAST(p_partkey % 21 - 10 AS DOUBLE) AS change_percent,
            CAST(p_size - 5 AS DOUBLE) AS pe_ratio,
            CASE p_partkey % 8
                WHEN 0 THEN '1,' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0')
                WHEN 1 THEN p_partkey || '.5M' WHEN 2 THEN p_partkey || 'B'
                WHEN 3 THEN p_partkey || 'k' WHEN 4 THEN '--' WHEN 5 THEN 'N/A'
                WHEN 6 THEN '' END AS volume,
            CASE p_partkey % 8
                WHEN 0 THEN p_partkey || '.25T' WHEN 1 THEN p_partkey || 'B'
                WHEN 2 THEN p_partkey || 'm' WHEN 3 THEN CAST(p_partkey AS VARCHAR)
                WHEN 4 THEN '-' WHEN 5 THEN 'n/a' WHEN 6 THEN 'bad' END AS market_cap,
            p_partkey AS part_no FROM part""",
    "matched": """
        SELECT CAST(event_id AS VARCHAR) AS news_id, 'S' || user_id AS symbol, ts AS news_time,
            strftime(ts, '%Y-%m-%d') AS news_date, event_type, event_type AS source,
            (value - 50) / 1000 AS daily_return, (value - 50) / 100 AS sentiment_score,
            CASE WHEN (value - 50) / 100 >= 0.05 THEN 'POSITIVE'
                 WHEN (value - 50) / 100 <= -0.05 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment_label,
            CAST(user_id AS DOUBLE) AS total_volume FROM events""",
    **_NUMBER_TEXT,
    "lexicon": f"""
        SELECT *, CASE WHEN lead > 0 THEN 'POSITIVE' WHEN lead < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL'
                END AS sentiment_label,
            CASE WHEN lead = 0 THEN 0.0
                 ELSE sign(lead) * least(0.9, 0.3 + abs(lead) * 0.2) END AS sentiment_score
        FROM (SELECT *, ({_words_sql(POSITIVE)}) - ({_words_sql(NEGATIVE)}) AS lead FROM posts)""",
    "scored": """
        SELECT * REPLACE (
            CASE WHEN short THEN 'neutral' ELSE lower(sentiment_label) END AS sentiment_label,
            CASE WHEN short THEN 0.0 ELSE round(sentiment_score, 4) END AS sentiment_score)
        FROM (SELECT *, length(trim(text_raw)) < 10 AS short FROM lexicon)""",
    "post_pairs": """
        SELECT m.post_id AS news_id, q.symbol AS stock_symbol, q.name AS stock_name,
            q.price AS current_price, q.change_percent AS daily_change_percent, q.market_cap,
            q.volume, m.headline AS news_headline, m.url AS news_url,
            m.sentiment_label AS news_sentiment, m.sentiment_score, m.created_iso AS published_at
        FROM (SELECT *, upper(split_part(unnest(stock_symbols), '-', 1)) AS key FROM scored) m
        JOIN quotes q ON m.key = q.symbol""",
    "groups": """
        SELECT stock_symbol, avg(sentiment_score) AS sentiment_score,
            avg(daily_change_percent) AS daily_change_percent,
            min(news_sentiment) FILTER (WHERE place = 1) AS news_sentiment,
            arg_min(stock_name, published_at || news_id) AS stock_name,
            arg_min(current_price, published_at || news_id) AS current_price,
            arg_min(market_cap, published_at || news_id) AS market_cap
        FROM pairs JOIN (
            SELECT stock_symbol, news_sentiment, row_number() OVER (
                PARTITION BY stock_symbol ORDER BY count(*) DESC, news_sentiment) AS place
            FROM pairs GROUP BY stock_symbol, news_sentiment) USING (stock_symbol, news_sentiment)
        GROUP BY stock_symbol""",
    "daily": """
        SELECT stock_symbol, substr(published_at, 1, 10) AS date,
            avg(sentiment_score) AS sentiment_score,
            avg(daily_change_percent) AS daily_change_percent,
            arg_max(current_price, published_at || news_id) AS current_price,
            arg_max(volume, published_at || news_id) AS volume, count(news_id) AS news_count
        FROM spairs GROUP BY ALL""",
    "changes": """
        SELECT *,
            lag(sentiment_score, 1) OVER w AS sentiment_lag_1,
            lag(sentiment_score, 2) OVER w AS sentiment_lag_2,
            lag(sentiment_score, 3) OVER w AS sentiment_lag_3,
            lag(sentiment_score, 5) OVER w AS sentiment_lag_5,
            lag(sentiment_score, 7) OVER w AS sentiment_lag_7,
            current_price / nullif(lag(current_price, 1) OVER w, 0) - 1 AS price_change_1d,
            current_price / nullif(lag(current_price, 3) OVER w, 0) - 1 AS price_change_3d,
            current_price / nullif(lag(current_price, 5) OVER w, 0) - 1 AS price_change_5d
        FROM daily WINDOW w AS (PARTITION BY stock_symbol ORDER BY date)""",
    "volatile": """
        SELECT *, stddev_samp(price_change_1d) OVER (PARTITION BY stock_symbol ORDER BY date
            ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS volatility_5d FROM changes""",
    "series": "SELECT * FROM volatile WHERE sentiment_lag_7 IS NOT NULL",
}

_BUILT_ON = {
    "clean_news": ("news",),
    "clean_stock": ("stock",),
    "daily_news": ("clean_news",),
    "daily_stock": ("clean_stock",),
    "joined": ("daily_news", "daily_stock"),
    "mentions": ("posts",),
    "lexicon": ("posts",),
    "scored": ("lexicon",),
    "post_pairs": ("scored", "quotes"),
    "groups": ("pairs",),
    "daily": ("spairs",),
    "changes": ("daily",),
    "volatile": ("changes",),
    "series": ("volatile",),
}


@lru_cache
def _needed(view: str) -> tuple[str, ...]:
    out: list[str] = []
    for base in _BUILT_ON.get(view, ()):
        out += [v for v in _needed(base) if v not in out]
    return (*out, view)


def sql(body: str, *views: str) -> str:
    """``body`` with the views it reads (and theirs) in a WITH clause."""
    names: list[str] = []
    for view in views:
        names += [v for v in _needed(view) if v not in names]
    if not names:
        return body.strip()
    ctes = ",\n".join(f"{name} AS ({SQL_VIEWS[name].strip()})" for name in names)
    return f"WITH {ctes}\n{body.strip()}"
