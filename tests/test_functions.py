import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from quotewire import functions as fn


@pytest.mark.parametrize("raw, clean", [
    ("  a \n\t b  c ", "a b c"), (None, ""), ("", ""), (" 　 ", ""), ("x\x85y\x1cz", "x y z"),
])
def test_clean_text(one, raw, clean):
    assert one(fn.clean_text, raw, kinds=["string"]) == clean


@pytest.mark.parametrize("raw, plain, extended", [
    ("$1,234.50", 1234.5, 1234.5), ("12%", 12.0, 12.0), ("+3", 3.0, 3.0), ("-7.5", -7.5, -7.5),
    ("1e3", 1000.0, 1000.0), (".5", 0.5, 0.5), ("5.", 5.0, 5.0), ("1 000", 0.0, 1000.0),
    ("N/A", 0.0, 0.0), ("--", 0.0, 0.0), ("-", 0.0, 0.0), ("", 0.0, 0.0), ("n/a", 0.0, 0.0),
    ("None", 0.0, 0.0), (None, 0.0, 0.0), ("1d", 0.0, 0.0), ("nan", 0.0, 0.0), ("1_000", 0.0, 0.0),
    (" 8 % ", 8.0, 8.0), ("50%%", 0.0, 0.0),
])
def test_safe_float(one, raw, plain, extended):
    assert one(fn.safe_float, raw, kinds=["string"]) == plain
    assert one(lambda c: fn.safe_float(c, extended=True), raw, kinds=["string"]) == extended


def test_round_half_up_is_round_of_doubles(spark):
    edges = [0.5, 1.5, 2.5, 0.49999999999999994, 0.5000000000000001, 4503599627370495.5, 4503599627370496.0, 9007199254740993.0, 1e300, 5e-324, 0.0, 999999.5, 2.675e6, math.inf]
    df = spark.createDataFrame([(s * x,) for x in edges for s in (1, -1)] + [(math.nan,), (None,)], "x double")
    df = df.unionByName(spark.range(200_000).select((F.col("id") / 64 - 1500).alias("x")))
    df = df.unionByName(spark.range(200_000).select((F.hash("id") / 1e6).alias("x")))
    different = ~F.round("x").eqNullSafe(fn.round_half_up(F.col("x")))
    signed = fn.round_half_up(F.col("x")).cast("string") == "-0.0"
    assert df.where(different | signed).count() == 0
    plan = df.select(fn.round_half_up(F.col("x")))._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan


def test_safe_float_default(one):
    assert one(lambda c: fn.safe_float(c, default=-1.0), "bad") == -1.0


@pytest.mark.parametrize("raw, value", [
    ("1.2M", 1.2e6), ("3B", 3e9), ("500k", 5e5), ("2T", 2e12), ("1,234", 1234.0), ("--", 0.0),
    ("N/A", 0.0), (None, 0.0), ("", 0.0), ("M", 0.0), ("x1M", 0.0),
])
def test_parse_units(one, raw, value):
    assert one(fn.parse_units, raw, kinds=["string"]) == pytest.approx(value)


@pytest.mark.parametrize("raw, value", [
    ("1.5m", 1.5e6), ("2B", 2e9), ("7K", 7e3), ("1,000", 1000.0), ("", None), (None, None),
    ("many", None), ("abc", None), ("m", None),
])
def test_parse_volume(one, raw, value):
    assert one(fn.parse_volume, raw, kinds=["string"]) == value


def test_counts(one):
    assert one(fn.url_count, "see http://a and https://b, not ftp://c") == 2
    assert one(fn.symbol_char_count, "Née? \U0001f600 (ok) $5 — x_1") == 5  # emoji ( ) $ dash
    assert one(fn.token_count, "  a b\n c ") == 3
    assert one(fn.token_count, None, kinds=["string"]) == 0


@pytest.mark.parametrize("raw, value", [
    ("2024-03-05T10:00:00Z", "2024-03-05 10:00:00"),
    ("2024-03-05T10:00:00+08:00", "2024-03-05 02:00:00"),
    ("Tue, March 5, 2024 at 6:30 PM GMT+8", "2024-03-05 10:30:00"),
    ("Tue, March 5, 2024 at 6:30 PM", "2024-03-05 10:30:00"),
    ("March 5, 2024", "2024-03-04 16:00:00"),
    ("Tue, 05 Mar 2024 10:00:00 +0000", "2024-03-05 10:00:00"),
    ("2024-03-05 08:00", "2024-03-05 00:00:00"),
    ("yesterday", None), ("", None), (None, None),
])
def test_parse_publish_date(one, raw, value):
    got = one(lambda c: F.date_format(fn.parse_publish_date(c), "yyyy-MM-dd HH:mm:ss"), raw, kinds=["string"])
    assert got == value


def test_publish_date_in_another_session_zone(spark, one):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(lambda c: F.unix_seconds(fn.parse_publish_date(c)), "March 5, 2024")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.datetime(2024, 3, 4, 16, tzinfo=dt.timezone.utc).timestamp()


def test_dates(one):
    assert one(fn.date_bucket, 1704067199) == "2023-12-31"
    assert one(fn.date_bucket, 1704067200) == "2024-01-01"
    assert one(fn.to_timestamp_coerce, "soon") is None
    hours = {0: "PRE_MARKET", 8: "PRE_MARKET", 9: "TRADING_HOUR", 15: "TRADING_HOUR",
             16: "AFTER_MARKET", 23: "AFTER_MARKET"}
    for hour, period in hours.items():
        assert one(fn.time_period, dt.datetime(2024, 1, 1, hour, 59)) == period


def test_symbols(one):
    assert one(fn.base_symbol, "btc-usd") == "BTC"
    assert one(fn.base_symbol, "es_f") == "ES_F"
    assert one(lambda c: fn.base_symbol(c, "-_"), "es_f") == "ES"
    assert one(lambda c: fn.first_symbol(F.split(c, ",")), "eth-usd,x") == "ETH"
    assert one(lambda c: fn.first_symbol(F.array().cast("array<string>")), 1) == "UNKNOWN"


@pytest.mark.parametrize("headline, text, symbol", [
    ("Tesla and Apple", "", "TSLA"),  # list order, not place in the text
    ("apple, then nvidia", None, "NVDA"),
    ("Buy $AB now", "XYZ", "AB"),
    ("é$ABCDEF", "about XYZQ here", "XYZQ"),
    ("éABC", "QRSTU.", "QRSTU"),  # a letter with accent is part of the word
    ("lowABC-usd", "", "ABC"),
    ("nothing here", "No", "UNKNOWN"),
    (None, None, "UNKNOWN"),
])
def test_symbol_from_text(one, headline, text, symbol):
    assert one(fn.symbol_from_text, headline, text, kinds=["string", "string"]) == symbol


@pytest.mark.parametrize("symbol, sector", [
    ("AAPL", "Technology"), ("C", "Finance"), ("ECONOMY", "Finance"), ("PFE", "Healthcare"),
    ("KO", "Consumer"), ("TSLA", "Other"), ("METAC", "Technology"),
])
def test_sector(one, symbol, sector):
    assert one(fn.sector_of, symbol) == sector


@pytest.mark.parametrize("score, kind, level, compound", [
    (0.6, "Positive", "Neutral", "positive"), (0.4, "Negative", "Neutral", "positive"),
    (0.3, "Negative", "Negative", "positive"), (0.7, "Positive", "Neutral", "positive"),
    (0.71, "Positive", "Positive", "positive"), (0.05, "Negative", "Negative", "positive"),
    (-0.05, "Negative", "Negative", "negative"), (0.0, "Negative", "Negative", "neutral"),
])
def test_labels(one, score, kind, level, compound):
    assert one(fn.sentiment_type, score) == kind
    assert one(fn.sentiment_level, score) == level
    assert one(fn.compound_label, score) == compound


@pytest.mark.parametrize("text, label, score", [
    ("Profit GROWTH", "POSITIVE", 0.7), ("profit profit", "POSITIVE", 0.5), ("loss", "NEGATIVE", -0.5),
    ("growth and decline", "NEUTRAL", 0.0), ("", "NEUTRAL", 0.0), (None, "NEUTRAL", 0.0),
    ("profit growth record surge rally", "POSITIVE", 0.9),
])
def test_lexicon(one, text, label, score):
    got = one(fn.lexicon_sentiment, text, kinds=["string"])
    assert got["label"] == label
    assert math.isclose(got["score"], score)


def test_pick_and_guard(one):
    assert one(fn.pick_text, None, "", "c", kinds=["string"] * 3) == "c"
    assert one(fn.pick_text, None, kinds=["string"]) == ""
    assert one(fn.headline_fallback, None, "x" * 200, kinds=["string", None]) == "x" * 100

    def guard(c):
        return fn.short_text_guard(c, F.struct(F.lit("positive").alias("label"), F.lit(0.5).alias("score")))

    assert tuple(one(guard, "  123456789  ")) == ("neutral", 0.0)
    assert tuple(one(guard, "1234567890")) == ("positive", 0.5)
    assert tuple(one(guard, None, kinds=["string"])) == ("neutral", 0.0)


def test_signed_score_and_direction(one):
    assert one(fn.signed_score, "negative", 0.8) == -0.8
    assert one(fn.signed_score, "neutral", 0.8) == 0.0
    assert one(fn.signed_score, "positive", 0.8) == 0.8
    assert one(fn.price_direction, 0.0) == 0
    assert one(fn.price_direction, None, kinds=["double"]) == 0
    assert one(fn.price_direction, 0.1) == 1


def test_now_utc_is_utc(one):
    shown = one(lambda c: fn.now_utc(), 1)
    now = dt.datetime.now(dt.timezone.utc)
    then = dt.datetime.fromisoformat(shown)
    assert abs((now - then).total_seconds()) < 600
