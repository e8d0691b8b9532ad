"""Text functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes are spelled out because the JVM's \s and \w are ASCII only.
SPACE = r"\p{Z}\t\n\x0B\f\r\x1C-\x1F\x85"
WORD = r"\p{L}\p{N}_"

# The characters of SPACE.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def squeeze(text: Column) -> Column:
    """Runs of white space become one space, ends are stripped."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def clean_text(text: Column) -> Column:
    """:func:`squeeze`, with '' for NULL."""
    return squeeze(F.coalesce(text, F.lit("")))


def strip(text: Column) -> Column:
    """White space (any Unicode kind) off both ends."""
    return F.btrim(text, F.lit(BLANKS))


def url_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("https?://"))


def symbol_char_count(text: Column) -> Column:
    """Characters that are no word character, white space or plain punctuation."""
    other = f"[^{WORD}{SPACE}" + r""",.'"!?;:]"""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(other))


def token_count(text: Column) -> Column:
    """White-space separated tokens."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+"))


def headline_fallback(headline: Column, text: Column) -> Column:
    """A missing headline is the first 100 characters of the text."""
    return F.coalesce(headline, F.substring(text, 1, 100))


def join_paragraphs(paragraphs: Column) -> Column:
    return F.array_join(paragraphs, " ")


def pick_text(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty, else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))
