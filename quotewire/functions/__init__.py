"""Column functions: every one is a built-in Column expression."""

from quotewire.functions.dates import (
    date_bucket,
    news_date,
    now_utc,
    parse_publish_date,
    time_period,
    to_timestamp_coerce,
)
from quotewire.functions.labels import (
    compound_label,
    lexicon_sentiment,
    sentiment_level,
    sentiment_type,
    short_text_guard,
    signed_score,
)
from quotewire.functions.numbers import (
    parse_units,
    parse_volume,
    price_direction,
    round_half_up,
    safe_float,
    to_numeric_coerce,
)
from quotewire.functions.symbols import (
    base_symbol,
    first_symbol,
    sector_of,
    symbol_from_text,
)
from quotewire.functions.text import (
    clean_text,
    headline_fallback,
    join_paragraphs,
    pick_text,
    symbol_char_count,
    token_count,
    url_count,
)

__all__ = [
    "base_symbol", "clean_text", "compound_label", "date_bucket", "first_symbol",
    "headline_fallback", "join_paragraphs", "lexicon_sentiment", "news_date", "now_utc",
    "parse_publish_date", "parse_units", "parse_volume", "pick_text", "price_direction", "round_half_up",
    "safe_float", "sector_of", "sentiment_level", "sentiment_type", "short_text_guard",
    "signed_score", "symbol_char_count", "symbol_from_text", "time_period",
    "to_numeric_coerce", "to_timestamp_coerce", "token_count", "url_count",
]
