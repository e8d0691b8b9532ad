"""Row types shared by sources and operators."""

from pyspark.sql import types as T


def struct_of(**fields: T.DataType) -> T.StructType:
    """Row type of the given columns, in order."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_SYMBOLS = T.ArrayType(_S)

STOCK = struct_of(
    stockCode=_S, date=_S, open=_D, high=_D, low=_D, close=_D, volume=_L
)

QUOTE = struct_of(
    symbol=_S, name=_S, price=_D, change_amount=_D, change_percent=_D, volume=_S,
    market_cap=_S, pe_ratio=_D, week52_change=_D, week52_range=_S, timestamp=_S, url=_S,
)

POST = struct_of(
    post_id=_S, created_utc=_L, created_iso=_S, subreddit=_S, author=_S, score=_I,
    num_comments=_I, text_raw=_S, url=_S, source=_S, type=_S, headline=_S,
    publisher=_S, stock_symbols=_SYMBOLS, most_active_stocks_url=_S,
)

CHUNK = struct_of(
    post_id=_S, parent_id=_S, chunk_idx=_I, chunk_total=_I, timestamp_utc=_L,
    date_bucket=_S, source=_S, platform=_S, author=_S, tickers=_SYMBOLS,
    stock_symbols=_SYMBOLS, url_count=_I, emoji_count=_I, token_count=_I,
    clean_text=_S, lang=_S, most_active_stocks_url=_S,
)

PAIR = struct_of(
    news_id=_S, stock_symbol=_S, stock_name=_S, current_price=_D,
    daily_change_percent=_D, market_cap=_S, volume=_S, news_headline=_S, news_url=_S,
    news_sentiment=_S, sentiment_score=_D, published_at=_S, analysis_timestamp=_S,
)
