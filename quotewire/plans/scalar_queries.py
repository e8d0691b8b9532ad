"""Queries of the column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewire import functions as fn
from quotewire.functions.symbols import KEYWORD_SYMBOLS, OTHER_SECTOR, SECTOR_SYMBOLS
from quotewire.functions.text import strip
from quotewire.plans.catalog import query, rounded
from quotewire.plans.inputs import NEGATIVE, POSITIVE, Inputs, sql

# White space, word characters and plain punctuation, as regular expression classes.
SPACE_SQL = r"\p{Z}\t\n\x0B\f\r\x1C-\x1F\x85"
OTHER_SQL = r"[^\p{L}\p{N}_" + SPACE_SQL + r",.''\"!?;:]"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _number_sql(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '{_NUMBER}') THEN TRY_CAST({text} AS DOUBLE) END"


def _strip_sql(text: str) -> str:
    return f"regexp_replace({text}, '^[{SPACE_SQL}]+|[{SPACE_SQL}]+$', '', 'g')"


_CLEAN = f"trim(regexp_replace(coalesce(text, ''), '[{SPACE_SQL}]+', ' ', 'g'))"


@query("clean_text", f"SELECT doc_id, {_CLEAN} AS cleaned FROM documents")
def clean_text(t: Inputs) -> DataFrame:
    return t.table("documents").select("doc_id", fn.clean_text(F.col("text")).alias("cleaned"))


def _safe_float_sql(drop: str, plus: str) -> str:
    bare = _strip_sql(f"regexp_replace(raw, '{drop}', '', 'g')")
    bare = _strip_sql(f"regexp_replace(regexp_replace({bare}, '%$', ''), '{plus}', '')")
    return f"""
        SELECT part_no, coalesce({_number_sql("bare")}, 0.0) AS number
        FROM (SELECT part_no, {bare} AS bare FROM number_texts)"""


@query("safe_float", sql(rounded(_safe_float_sql("[,$]", r"^\+"), "number"), "number_texts"))
def safe_float(t: Inputs) -> DataFrame:
    return t.number_texts().select("part_no", fn.safe_float(F.col("raw")).alias("number"))


@query("safe_float_ext", sql(rounded(_safe_float_sql("[,$ ]", "^$"), "number"), "number_texts"))
def safe_float_ext(t: Inputs) -> DataFrame:
    return t.number_texts().select(
        "part_no", fn.safe_float(F.col("raw"), extended=True).alias("number")
    )


_UNIT = """CASE right({0}, 1) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9
    WHEN 'T' THEN 1e12 ELSE 1 END"""


def units_sql(column: str) -> str:
    """Number with a unit letter, in SQL."""
    value = f"upper(replace(trim({column}), ',', ''))"
    body = f"regexp_replace(regexp_replace({value}, '[KMBT]$', ''), '[$ ]', '', 'g')"
    return f"coalesce(TRY_CAST(CASE WHEN regexp_matches({body}, '{_NUMBER}') THEN {body} END AS DOUBLE), 0.0) * {_UNIT.format(value)}"


@query(
    "parse_units",
    sql(
        rounded(
            f"""SELECT symbol, coalesce({units_sql("volume")}, 0.0) AS volume,
                coalesce({units_sql("market_cap")}, 0.0) AS market_cap FROM part_quotes""",
            "volume", "market_cap",
        ),
        "part_quotes",
    ),
)
def parse_units(t: Inputs) -> DataFrame:
    return t.part_quotes().select(
        "symbol",
        fn.parse_units(F.col("volume")).alias("volume"),
        fn.parse_units(F.col("market_cap")).alias("market_cap"),
    )


def volume_sql(column: str) -> str:
    """Volume text to a number or NULL, in SQL."""
    v = f"lower(replace(trim({column}), ',', ''))"
    return f"""CASE WHEN contains({v}, 'm') THEN TRY_CAST(replace({v}, 'm', '') AS DOUBLE) * 1e6
        WHEN contains({v}, 'b') THEN TRY_CAST(replace({v}, 'b', '') AS DOUBLE) * 1e9
        WHEN contains({v}, 'k') THEN TRY_CAST(replace({v}, 'k', '') AS DOUBLE) * 1e3
        WHEN regexp_matches({v}, '{_NUMBER}') THEN TRY_CAST({v} AS DOUBLE) END"""


@query(
    "parse_volume",
    sql(
        rounded(
            f"SELECT symbol, {volume_sql('volume')} AS volume_num, "
            f"{volume_sql('market_cap')} AS cap_num FROM part_quotes",
            "volume_num", "cap_num",
        ),
        "part_quotes",
    ),
)
def parse_volume(t: Inputs) -> DataFrame:
    return t.part_quotes().select(
        "symbol",
        fn.parse_volume(F.col("volume")).alias("volume_num"),
        fn.parse_volume(F.col("market_cap")).alias("cap_num"),
    )


@query(
    "to_numeric_coerce",
    sql(
        rounded(
            f"SELECT part_no, {_number_sql(_strip_sql('raw'))} AS number FROM number_texts", "number"
        ),
        "number_texts",
    ),
)
def to_numeric_coerce(t: Inputs) -> DataFrame:
    return t.number_texts().select("part_no", fn.to_numeric_coerce(F.col("raw")).alias("number"))


@query(
    "url_count",
    r"SELECT page_id, len(regexp_extract_all(url || ' ' || html, 'https?://')) AS urls FROM pages",
)
def url_count(t: Inputs) -> DataFrame:
    return t.table("pages").select(
        "page_id", fn.url_count(F.concat_ws(" ", "url", "html")).alias("urls")
    )


@query(
    "symbol_char_count",
    f"SELECT doc_id, len(regexp_extract_all(text, '{OTHER_SQL}')) AS symbol_chars FROM documents",
)
def symbol_char_count(t: Inputs) -> DataFrame:
    return t.table("documents").select(
        "doc_id", fn.symbol_char_count(F.col("text")).alias("symbol_chars")
    )


@query(
    "token_count",
    f"""SELECT conv_id, turn, len(list_filter(
        regexp_split_to_array(text, '[{SPACE_SQL}]+'), lambda x: x <> '')) AS tokens
    FROM conversations""",
)
def token_count(t: Inputs) -> DataFrame:
    return t.table("conversations").select(
        "conv_id", "turn", fn.token_count(F.col("text")).alias("tokens")
    )


@query("date_bucket", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def date_bucket(t: Inputs) -> DataFrame:
    return t.table("events").select("event_id", fn.date_bucket(F.unix_seconds("ts")).alias("day"))


@query(
    "news_date",
    sql("SELECT newsId, strftime(newsTime, '%Y-%m-%d') AS newsDate FROM news", "news"),
)
def news_date(t: Inputs) -> DataFrame:
    return t.news().select("newsId", fn.news_date(F.col("newsTime")).alias("newsDate"))


@query(
    "parse_publish_date",
    """SELECT event_id, strftime(utc, '%Y-%m-%d %H:%M:%S') AS published,
        CAST(epoch(utc) AS BIGINT) AS published_utc
    FROM (SELECT event_id, CASE event_id % 6
        WHEN 0 THEN date_trunc('minute', ts) - INTERVAL 8 HOUR
        WHEN 1 THEN date_trunc('day', ts) - INTERVAL 8 HOUR
        WHEN 2 THEN date_trunc('second', ts)
        WHEN 3 THEN date_trunc('second', ts) - INTERVAL 8 HOUR
        WHEN 4 THEN date_trunc('minute', ts) + INTERVAL 5 HOUR END AS utc FROM events)""",
)
def parse_publish_date(t: Inputs) -> DataFrame:
    def written(pattern: str):
        return F.date_format("ts", pattern)

    i = F.col("event_id") % 6
    text = (
        F.when(i == 0, written("EEE, MMMM d, yyyy 'at' h:mm a"))
        .when(i == 1, written("MMMM d, yyyy"))
        .when(i == 2, written("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(i == 3, written("  yyyy-MM-dd   HH:mm:ss"))
        .when(i == 4, written("EEE, MMMM d, yyyy 'at' h:mm a 'GMT-5'"))
        .otherwise(F.lit("three days ago, perhaps"))
    )
    published = fn.parse_publish_date(text)
    return t.table("events").select(
        "event_id", published.alias("published"), F.unix_seconds(published).alias("published_utc")
    )


_TIME_TEXT = """CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN strftime(ts, '%Y-%m-%d') WHEN 2 THEN 'unknown' END"""


@query(
    "to_timestamp_coerce",
    f"""SELECT event_id, strftime(TRY_CAST({_TIME_TEXT} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')
        AS news_time FROM events""",
)
def to_timestamp_coerce(t: Inputs) -> DataFrame:
    i = F.col("event_id") % 4
    text = (
        F.when(i == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(i == 1, F.date_format("ts", "yyyy-MM-dd")).when(i == 2, "unknown")
    )
    return t.table("events").select("event_id", fn.to_timestamp_coerce(text).alias("news_time"))


@query(
    "base_symbol",
    """SELECT part_no, upper(split_part(raw, '-', 1)) AS joined,
        upper(regexp_extract(raw, '^[^-_]*')) AS extracted
    FROM (SELECT p_partkey AS part_no, lower(p_type) || CASE p_partkey % 3 WHEN 0 THEN '-usd'
        WHEN 1 THEN '_x-y' ELSE '' END AS raw FROM part)""",
)
def base_symbol(t: Inputs) -> DataFrame:
    i = F.col("p_partkey") % 3
    raw = F.concat(F.lower("p_type"), F.when(i == 0, "-usd").when(i == 1, "_x-y").otherwise(""))
    return t.table("part").select(
        F.col("p_partkey").alias("part_no"),
        fn.base_symbol(raw).alias("joined"),
        fn.base_symbol(raw, "-_").alias("extracted"),
    )


@query(
    "first_symbol",
    sql(
        """SELECT post_id, coalesce(upper(split_part(stock_symbols[1], '-', 1)), 'UNKNOWN')
            AS matched_symbol FROM posts""",
        "posts",
    ),
)
def first_symbol(t: Inputs) -> DataFrame:
    return t.posts().select("post_id", fn.first_symbol(F.col("stock_symbols")).alias("matched_symbol"))


_WORD = r"\p{L}\p{N}_"
KEYWORDS_SQL = " ".join(
    f"WHEN contains(lower(whole), '{word}') THEN '{symbol}'" for word, symbol in KEYWORD_SYMBOLS.items()
)
FROM_TEXT_SQL = f"""CASE {KEYWORDS_SQL} ELSE coalesce(
    nullif(regexp_extract(whole, '\\$([A-Z]{{1,5}})(?:$|[^{_WORD}])', 1), ''),
    nullif(regexp_extract(whole, '(?:^|[^{_WORD}])([A-Z]{{3,5}})(?:$|[^{_WORD}])', 1), ''),
    nullif(regexp_extract(whole, '([A-Z]{{3,5}})[-.]', 1), ''), 'UNKNOWN') END"""


@query(
    "symbol_from_text",
    sql(
        f"""SELECT post_id, {FROM_TEXT_SQL} AS matched_symbol FROM (
            SELECT post_id, coalesce(headline, '') || ' ' || text_raw AS whole FROM posts)""",
        "posts",
    ),
)
def symbol_from_text(t: Inputs) -> DataFrame:
    return t.posts().select(
        "post_id",
        fn.symbol_from_text(F.col("headline"), F.col("text_raw")).alias("matched_symbol"),
    )


@query(
    "headline_fallback",
    sql("SELECT post_id, coalesce(headline, substr(text_raw, 1, 100)) AS headline FROM posts", "posts"),
)
def headline_fallback(t: Inputs) -> DataFrame:
    return t.posts().select(
        "post_id", fn.headline_fallback(F.col("headline"), F.col("text_raw")).alias("headline")
    )


@query(
    "join_paragraphs",
    "SELECT doc_id, array_to_string(string_split(text, chr(10)), ' ') AS text FROM documents",
)
def join_paragraphs(t: Inputs) -> DataFrame:
    return t.table("documents").select(
        "doc_id", fn.join_paragraphs(F.split("text", "\n")).alias("text")
    )


@query(
    "time_period",
    """SELECT event_id, CASE WHEN hour(ts) BETWEEN 9 AND 15 THEN 'TRADING_HOUR'
        WHEN hour(ts) >= 16 THEN 'AFTER_MARKET' ELSE 'PRE_MARKET' END AS time_period FROM events""",
)
def time_period(t: Inputs) -> DataFrame:
    return t.table("events").select("event_id", fn.time_period(F.col("ts")).alias("time_period"))


@query(
    "sentiment_type",
    sql(
        """SELECT newsId, CASE WHEN sentiment >= 0.6 THEN 'Positive' WHEN sentiment <= 0.4
            THEN 'Negative' ELSE 'Neutral' END AS sentimentType FROM news""",
        "news",
    ),
)
def sentiment_type(t: Inputs) -> DataFrame:
    return t.news().select("newsId", fn.sentiment_type(F.col("sentiment")).alias("sentimentType"))


@query(
    "sentiment_level",
    sql(
        """SELECT newsId, CASE WHEN sentiment <= 0.3 THEN 'Negative' WHEN sentiment <= 0.7
            THEN 'Neutral' ELSE 'Positive' END AS sentimentLevel FROM news""",
        "news",
    ),
)
def sentiment_level(t: Inputs) -> DataFrame:
    return t.news().select("newsId", fn.sentiment_level(F.col("sentiment")).alias("sentimentLevel"))


@query(
    "compound_label",
    """SELECT event_id, CASE WHEN value / 50 - 1 >= 0.05 THEN 'positive'
        WHEN value / 50 - 1 <= -0.05 THEN 'negative' ELSE 'neutral' END AS label FROM events""",
)
def compound_label(t: Inputs) -> DataFrame:
    return t.table("events").select(
        "event_id", fn.compound_label(F.col("value") / 50 - 1).alias("label")
    )


@query(
    "signed_score",
    sql(
        rounded(
            """SELECT news_id, CASE news_sentiment WHEN 'negative' THEN -abs(sentiment_score)
                WHEN 'neutral' THEN 0.0 ELSE abs(sentiment_score) END AS score FROM pairs""",
            "score",
        ),
        "pairs",
    ),
)
def signed_score(t: Inputs) -> DataFrame:
    score = fn.signed_score(F.col("news_sentiment"), F.abs("sentiment_score"))
    return t.pairs().select("news_id", score.alias("score"))


def _sector_sql(symbol: str) -> str:
    def any_of(*parts: str) -> str:
        return " OR ".join(f"contains({symbol}, '{p}')" for p in parts)

    cases = " ".join(f"WHEN {any_of(*members)} THEN '{sector}'" for sector, members in SECTOR_SYMBOLS.items())
    return f"CASE {cases} ELSE '{OTHER_SECTOR}' END"


_SECTOR_SYMBOL = """CASE p_partkey % 6 WHEN 0 THEN 'AAPL' WHEN 1 THEN 'JPM' WHEN 2 THEN 'PFE'
    WHEN 3 THEN 'WMT' WHEN 4 THEN p_type ELSE 'P' || p_partkey END"""


@query(
    "sector_of",
    f"""SELECT part_no, symbol, {_sector_sql("symbol")} AS sector
    FROM (SELECT p_partkey AS part_no, {_SECTOR_SYMBOL} AS symbol FROM part)""",
)
def sector_of(t: Inputs) -> DataFrame:
    i = F.col("p_partkey") % 6
    symbol = (
        F.when(i == 0, "AAPL").when(i == 1, "JPM").when(i == 2, "PFE").when(i == 3, "WMT")
        .when(i == 4, F.col("p_type")).otherwise(F.concat(F.lit("P"), "p_partkey"))
    )
    return t.table("part").select(
        F.col("p_partkey").alias("part_no"), symbol.alias("symbol"),
        fn.sector_of(symbol).alias("sector"),
    )


@query(
    "price_direction",
    sql(
        """SELECT news_id, CAST(daily_change_percent > 0 AS BIGINT) AS price_direction
        FROM pairs""",
        "pairs",
    ),
)
def price_direction(t: Inputs) -> DataFrame:
    return t.pairs().select(
        "news_id", fn.price_direction(F.col("daily_change_percent")).alias("price_direction")
    )


@query(
    "lexicon_sentiment",
    sql(
        rounded("SELECT post_id, sentiment_label, sentiment_score FROM lexicon", "sentiment_score"),
        "lexicon",
    ),
)
def lexicon_sentiment(t: Inputs) -> DataFrame:
    scored = fn.lexicon_sentiment(F.col("text_raw"), POSITIVE, NEGATIVE)
    return t.posts().select(
        "post_id", scored["label"].alias("sentiment_label"), scored["score"].alias("sentiment_score")
    )


@query(
    "pick_text",
    sql(
        """SELECT post_id, coalesce(nullif(substr(coalesce(headline, ''), 3), ''), nullif(author, ''),
            text_raw, '') AS picked FROM posts""",
        "posts",
    ),
)
def pick_text(t: Inputs) -> DataFrame:
    return t.posts().select(
        "post_id",
        fn.pick_text(F.expr("substr(headline, 3)"), F.col("author"), F.col("text_raw")).alias("picked"),
    )


@query(
    "short_text_guard",
    """SELECT part_no, CASE WHEN length(name) < 10 THEN 'neutral' ELSE 'positive' END AS label,
        CASE WHEN length(name) < 10 THEN 0.0 ELSE 0.75 END AS score
    FROM (SELECT p_partkey AS part_no, trim(p_name) AS name FROM part)""",
)
def short_text_guard(t: Inputs) -> DataFrame:
    given = F.struct(F.lit("positive").alias("label"), F.lit(0.75).alias("score"))
    return t.table("part").select(
        F.col("p_partkey").alias("part_no"),
        fn.short_text_guard(strip(F.col("p_name")), given).alias("s"),
    ).select("part_no", "s.*")
