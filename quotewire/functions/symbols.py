"""Ticker symbols."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotewire.functions.common import let
from quotewire.functions.text import WORD

UNKNOWN = "UNKNOWN"

# Company keywords, in order of precedence, and their symbols.
KEYWORD_SYMBOLS = {
    "nvidia": "NVDA",
    "kenvue": "KVUE",
    "bonk": "BONK",
    "solana": "SOL",
    "bitcoin": "BTC",
    "ethereum": "ETH",
    "tesla": "TSLA",
    "apple": "AAPL",
    "microsoft": "MSFT",
    "google": "GOOGL",
    "amazon": "AMZN",
    "meta": "META",
}

# A symbol containing one of these belongs to the first such sector.
SECTOR_SYMBOLS = {
    "Technology": ("AAPL", "MSFT", "GOOGL", "META", "NVDA"),
    "Finance": ("JPM", "BAC", "WFC", "C", "GS"),
    "Healthcare": ("PFE", "JNJ", "MRK", "ABBV", "UNH"),
    "Consumer": ("AMZN", "WMT", "PG", "KO", "PEP"),
}
OTHER_SECTOR = "Other"

# '$AB', a word of 3-5 capitals, 3-5 capitals before '-' or '.'. Word edges are
# written out because \b knows ASCII words only; each pattern starts with a plain
# character class, so that most of a text is passed over quickly.
SYMBOL_PATTERNS = (
    rf"\$([A-Z]{{1,5}})(?![{WORD}])",
    rf"(?=[A-Z])(?<![{WORD}])([A-Z]{{3,5}})(?![{WORD}])",
    r"([A-Z]{3,5})[-.]",
)


def base_symbol(symbol: Column, separators: str = "-") -> Column:
    """Upper-case symbol before the first separator: 'btc-usd' -> 'BTC'."""
    return F.upper(F.regexp_extract(symbol, f"^[^{separators}]*", 0))


def first_symbol(symbols: Column) -> Column:
    """Base symbol of the first entry of an array of symbols, else UNKNOWN."""
    first = F.try_element_at(symbols, F.lit(1))
    return F.coalesce(base_symbol(first), F.lit(UNKNOWN))


def symbol_from_text(
    headline: Column, text: Column, keywords: Mapping[str, str] = KEYWORD_SYMBOLS
) -> Column:
    """Symbol named in an article: by keyword, else by how symbols are written."""
    whole = F.concat_ws(" ", F.coalesce(headline, F.lit("")), F.coalesce(text, F.lit("")))

    def by_keyword(lowered: Column) -> Column:
        return F.coalesce(
            F.lit(None).cast("string"),
            *[F.when(lowered.contains(word), F.lit(s)) for word, s in keywords.items()],
        )

    def found(whole: Column) -> Column:
        by_pattern = [
            F.when(whole.rlike(p), F.regexp_extract(whole, p, 1)) for p in SYMBOL_PATTERNS
        ]
        return F.coalesce(let(F.lower(whole), by_keyword), *by_pattern, F.lit(UNKNOWN))

    return let(whole, found)


def sector_of(
    symbol: Column, sectors: Mapping[str, Sequence[str]] = SECTOR_SYMBOLS
) -> Column:
    found = [
        F.when(symbol.contains(member), F.lit(sector))
        for sector, members in sectors.items()
        for member in members
    ]
    return F.coalesce(*found, F.lit(OTHER_SECTOR))
