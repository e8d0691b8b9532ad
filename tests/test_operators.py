import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from quotewire.operators import (
    cleaning,
    cubes,
    feeds,
    joins,
    keyed,
    quantiles,
    ranking,
    sentiment,
    stats,
    summaries,
    timeseries,
)

PAIR = (
    "news_id string, stock_symbol string, stock_name string, current_price double, "
    "daily_change_percent double, market_cap string, volume string, news_headline string, "
    "news_sentiment string, sentiment_score double, published_at string"
)


def pair(i, symbol, score=0.0, change=0.0, price=1.0, day="2024-01-01", label="neutral", name="n"):
    return (str(i), symbol, name, price, change, "1B", "5", "h", label, score, f"{day}T00:00:00+00:00")


def pairs(spark, *rows_):
    return spark.createDataFrame(list(rows_), PAIR)


# --- cleaning ---------------------------------------------------------------------------


def test_clean_news_drops_nulls_and_out_of_range(spark):
    t = dt.datetime(2024, 1, 1, 23, 59)
    df = spark.createDataFrame(
        [("1", t, "s", 0.0), ("2", t, "s", 1.0), ("3", t, "s", 1.01), (None, t, "s", 0.5),
         ("5", None, "s", 0.5), ("6", t, None, None), ("7", t, None, 0.5), ("8", t, "s", -0.01)],
        "newsId string, newsTime timestamp, newsSource string, sentiment double",
    )
    got = rows(cleaning.clean_news(df), "newsId", "newsDate")
    assert got == [("1", "2024-01-01"), ("2", "2024-01-01"), ("7", "2024-01-01")]


def test_clean_stock_edges(spark):
    schema = "stockCode string, date string, open double, high double, low double, close double, volume long"
    df = spark.createDataFrame(
        [("up", "d", 100.0, 110.0, 100.0, 110.0, 1), ("down", "d", 100.0, 100.0, 90.0, 90.0, 1),
         ("far", "d", 100.0, 120.0, 100.0, 111.0, 1), ("zero", "d", 0.0, 1.0, 0.0, 1.0, 1),
         ("novol", "d", 1.0, 1.0, 1.0, 1.0, 0), ("high", "d", 2.0, 1.0, 1.0, 1.0, 1),
         ("null", "d", None, 1.0, 1.0, 1.0, 1)],
        schema,
    )
    assert [r[0] for r in rows(cleaning.clean_stock(df), "stockCode")] == ["down", "up"]


def test_quote_aliases(spark):
    df = spark.createDataFrame([("A", "1.5", "2M"), (None, "1", "1"), ("B", "x", "1")],
                               "ticker string, current_price string, dayvolume string")
    got = cleaning.clean_quotes(df)
    assert rows(got, "symbol", "price", "volume_num", "change_percent") == [("A", 1.5, 2e6, 0.0)]
    assert got.first()["stock_date"] is None
    # one standard name is enough to stop the search for aliases
    mixed = spark.createDataFrame([("A", 1.0)], "symbol string, current_price double")
    with pytest.raises(ValueError):
        cleaning.clean_quotes(mixed)


def test_a_change_that_is_no_number_is_null(spark):
    df = spark.createDataFrame([("A", "1", "1.5%"), ("B", "2", "-0.5"), ("C", "3", None)],
                               "symbol string, price string, change_percent string")
    assert rows(cleaning.clean_quotes(df), "symbol", "change_percent") == [("A", None), ("B", -0.5), ("C", None)]


def test_quotes_with_bad_time_are_dropped(spark):
    df = spark.createDataFrame([("A", 1.0, "2024-01-02T03:04:05"), ("B", 1.0, "soon")],
                               "symbol string, price double, created_iso string")
    got = rows(cleaning.clean_quotes(df), "symbol", "stock_date")
    assert got == [("A", dt.date(2024, 1, 2))]


def test_clean_articles_variants(spark):
    df = spark.createDataFrame(
        [(["p one", "p two"], 0, "abc-usd", None), (["x"], 0, " ", "s"), (["x"], None, "A", "s")],
        "body array<string>, created_utc long, tickers string, publisher string",
    )
    got = cleaning.clean_articles(df, default_source="wire")
    assert rows(got, "text_raw", "headline", "source", "matched_symbol") == [
        ("p one p two", "p one p two", "wire", "ABC")
    ]
    with pytest.raises(ValueError):
        cleaning.clean_articles(df.drop("body"))


def test_with_returns_keeps_what_is_there(spark):
    df = spark.createDataFrame([("A", 5.0, 0.9)], "symbol string, change_percent double, daily_return double")
    r = cleaning.with_returns(df).first()
    assert (r["daily_return"], r["total_volume"], r["price_volatility"]) == (0.9, 0.0, 0.01)


# --- keys, joins --------------------------------------------------------------------------


def test_pick_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 1, "y")], "k string, o int, v string")
    assert rows(keyed.pick_first(df, ["k"], ["o"])) == [("a", 1, None), ("b", 1, "y")]
    assert rows(keyed.pick_last(df, ["k"], ["o"])) == [("a", 2, "x"), ("b", 1, "y")]


SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # partitions of a test are small enough to be merged into one
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, split where a test's partitions are skewed."""
    old = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_facts(spark, n):
    return spark.range(0, n, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("key")
    )


def test_lookup_join_with_a_hot_key(spark):
    facts = hot_facts(spark, 30_000)
    lookup = spark.range(400).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    got = keyed.lookup_join(facts, lookup, "key")
    assert got.columns == ["key", "id", "value"]
    want = facts.join(lookup, "key").agg(F.count("*"), F.sum("id"), F.sum("value")).first()
    assert got.agg(F.count("*"), F.sum("id"), F.sum("value")).first() == want
    assert keyed.lookup_join(facts, lookup, "key", how="left").count() == 30_000
    nulls = facts.withColumn("key", F.lit(None).cast("long"))
    assert keyed.lookup_join(nulls, lookup, "key").count() == 0


def test_hot_key_is_split_where_the_lookup_is_shuffled(shuffled):
    """The lookup is an aggregate over the join's key, whose place Spark would reuse."""
    facts = hot_facts(shuffled, 200_000)
    lookup = facts.groupBy("key").agg(F.max("id").alias("value"))
    got = keyed.lookup_join(facts, lookup, "key")
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    hot = got.where("value > 0 AND key = 0").select(F.spark_partition_id().alias("p")).distinct()
    assert hot.count() > 1
    assert got.count() == 200_000


def test_equal_order_is_settled_by_the_row(spark):
    """The picked row does not depend on the order in which rows arrive."""
    pairs = [("a", 1, "x", 5.0), ("a", 1, "y", 6.0), ("a", 1, None, 7.0)]
    schema = "k string, o int, v string, w double"
    picked = {
        rows(pick(spark.createDataFrame(some, schema).coalesce(1), ["k"], ["o"]))[0]
        for some in (pairs, pairs[::-1], pairs[1:] + pairs[:1]) for pick in (keyed.pick_first,)
    }
    assert len(picked) == 1


def test_large_limit_per_group_cuts_a_hot_group_in_parts(spark):
    df = hot_facts(spark, 20_000)
    got = ranking.limit_per_group(df, "key", ["id"], 2000)
    kept = got.where("key = 0").select("id").collect()
    assert sorted(r["id"] for r in kept) == [r["id"] for r in df.where("key = 0").orderBy("id").limit(2000).collect()]
    assert got.count() == 2000 + df.where("key <> 0").count()
    assert got.columns == df.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") >= 2


def quote_frame(spark, *rows_):
    return spark.createDataFrame(
        list(rows_),
        "symbol string, name string, price double, change_percent double, market_cap string, "
        "volume string, timestamp string",
    )


def test_integrate(spark):
    quotes = quote_frame(
        spark, ("btc", "old", 1.0, 1.0, "", "", "1"), ("BTC", "new", 2.0, 2.0, "", "", "2"),
        ("ETH", "e", 3.0, 3.0, "", "", "1"), (None, "x", 1.0, 1.0, "", "", "1"),
    )
    posts = spark.createDataFrame(
        [("p1", "h", "u", "t", ["BTC", "btc-usd", "DOGE"]), ("p2", None, "u", "t", []), ("p3", "h", "u", "t", None)],
        "post_id string, headline string, url string, created_iso string, stock_symbols array<string>",
    )
    got = joins.integrate(quotes, posts)
    assert got.columns == [
        "news_id", "stock_symbol", "stock_name", "current_price", "daily_change_percent", "market_cap",
        "volume", "news_headline", "news_url", "news_sentiment", "sentiment_score", "published_at",
        "analysis_timestamp",
    ]
    shown = ["news_id", "stock_symbol", "stock_name", "news_sentiment", "sentiment_score"]
    assert rows(got, *shown) == [("p1", "BTC", "new", "neutral", 0.0)] * 2
    assert joins.integrate(quotes, posts, dedupe=True).count() == 1


def news_frame(spark, *rows_):
    return spark.createDataFrame(list(rows_), "post_id string, matched_symbol string").withColumns(
        {"news_time": F.lit("2024-01-01").cast("timestamp"), "news_date": F.lit("2024-01-01").cast("date")}
    )


def returns_frame(spark, *rows_):
    return spark.createDataFrame(
        list(rows_),
        "symbol string, daily_return double, total_volume double, price_volatility double, o int",
    )


def test_match_takes_the_first_quote(spark):
    news = news_frame(spark, ("1", "a"), ("2", "B"))
    quotes = returns_frame(spark, ("A", 0.2, 5.0, 0.01, 2), ("a", 0.1, 4.0, 0.01, 1), ("C", 0.3, 1.0, 0.01, 1))
    for match in (joins.match_news, joins.match_news_or_default):
        got = match(news, quotes, ["o"])
        assert rows(got, "post_id", "symbol", "daily_return", "total_volume") == [("1", "A", 0.1, 4.0)]


@pytest.mark.parametrize("quotes", [[], [("X", 0.2, 5.0, 0.01, 2)]])
def test_no_match_at_all_keeps_everything(spark, quotes):
    news = news_frame(spark, ("1", "a"), ("2", "B"))
    got = joins.match_news_or_default(news, returns_frame(spark, *quotes), ["o"])
    assert rows(got, "post_id", "symbol", "daily_return", "total_volume") == [
        ("1", "A", 0.0, 0.0), ("2", "B", 0.0, 0.0)
    ]


def timed_news(spark, *rows_):
    return spark.createDataFrame(list(rows_), "post_id string, matched_symbol string, at string").select(
        "post_id", "matched_symbol", F.to_timestamp("at").alias("news_time"),
        F.to_date(F.to_timestamp("at")).alias("news_date"), F.lit("kept").alias("total_volume"),
    )


def timed_quotes(spark, *rows_):
    frame = spark.createDataFrame(list(rows_), "symbol string, at string, daily_return double, o int")
    return frame.select(
        "symbol", F.to_timestamp("at").alias("stock_time"), "daily_return", F.lit(1.0).alias("total_volume"),
        F.lit(0.01).alias("price_volatility"), "o",
    )


def test_match_within_a_window_takes_the_nearest_quote(spark):
    news = timed_news(
        spark, ("near", "a", "2024-01-02 00:10:00"), ("edge", "a", "2024-01-03 12:00:00"),
        ("tie", "A", "2024-01-05 12:00:00"), ("far", "a", "2024-02-01 00:00:00"),
        ("other", "x", "2024-01-02 00:10:00"), ("untimed", "a", None), ("null", None, "2024-01-02 00:10:00"),
        ("near", "a", "2024-01-02 00:10:00"),
    )
    quotes = timed_quotes(
        spark, ("A", "2024-01-01 23:00:00", 0.1, 1), ("a", "2024-01-02 02:00:00", 0.2, 1),  # over midnight
        ("a", "2024-01-02 12:00:00", 0.3, 2), ("a", "2024-01-02 12:00:00", 0.4, 1),  # a day before "edge"
        ("a", "2024-01-05 11:00:00", None, 1), ("a", "2024-01-05 13:00:00", 0.6, 1),
        ("a", None, 0.9, 1), (None, "2024-01-02 00:10:00", 0.9, 1),
    )
    got = joins.match_news_within(news, quotes, ["o"])
    assert got.columns == ["symbol", "post_id", "matched_symbol", "news_time", "news_date", "daily_return",
                           "total_volume", "price_volatility", "stock_date", "stock_time"]
    assert rows(got, "post_id", "symbol", "daily_return", "total_volume") == [
        ("edge", "A", 0.4, 1.0), ("near", "A", 0.1, 1.0), ("near", "A", 0.1, 1.0), ("tie", "A", 0.0, 1.0)
    ]
    assert rows(got.where("post_id = 'tie'").select(F.date_format("stock_time", "HH").alias("h"))) == [("11",)]
    assert rows(joins.match_news_within(news, quotes, ["o"], "1 hour"), "post_id") == [("tie",)]
    assert joins.match_news_within(news, quotes.limit(0), ["o"]).count() == 0


def test_match_within_same_as_trying_all_quotes(spark):
    import random

    rng = random.Random(4)
    when = lambda: f"2024-01-{rng.randrange(1, 6):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00"
    articles = [(str(i), "hot" if i % 3 else f"s{i % 5}", when()) for i in range(200)]
    prices = [("HOT" if i % 3 else f"S{i % 5}", when(), float(i), i) for i in range(200)]
    want = []
    seconds = lambda t: dt.datetime.fromisoformat(t).timestamp()
    for post, symbol, at in articles:
        near = [(abs(seconds(q[1]) - seconds(at)), seconds(q[1]), q[3], q[2]) for q in prices if q[0] == symbol.upper()]
        near = [n for n in near if n[0] <= 3 * 3600]
        if near:
            want.append((post, min(near)[3]))
    got = joins.match_news_within(timed_news(spark, *articles), timed_quotes(spark, *prices), ["o"], "3 hours")
    assert rows(got, "post_id", "daily_return") == sorted(want, key=repr) and 50 < len(want)


# --- cubes --------------------------------------------------------------------------------


def test_a_cube_tells_null_keys_from_absent_ones(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", None, 4.0), (None, 1, 6.0)], "x string, `y z` int, v double")
    got = cubes.cube(df, [["x"], ["y z"], ["x", "y z"], []], n=F.count("*"), mean=F.avg("v"))
    assert rows(got, "set", "x", "`y z`", "n", "mean") == sorted([
        (0, "a", None, 2, 3.0), (0, None, None, 1, 6.0), (1, None, 1, 2, 4.0), (1, None, None, 1, 4.0),
        (2, "a", 1, 1, 2.0), (2, "a", None, 1, 4.0), (2, None, 1, 1, 6.0), (3, None, None, 3, 4.0),
    ], key=repr)
    assert rows(cubes.cube(df.limit(0), [["x"], []], n=F.count("*"))) == []


def test_cube_tables_same_as_one_query_each(spark):
    from quotewire.plans.inputs import Inputs

    t = Inputs(spark, "/root/testdata/sf0.001")
    matched = t.matched()
    odd = matched.limit(3).withColumns({c: F.lit(None).cast(matched.schema[c].dataType) for c in
                                        ("sentiment_label", "source", "symbol", "event_type", "news_time")})
    matched = matched.unionByName(odd)
    table = cubes.matched_cube(matched)
    for name in ("sentiment_return", "source_impact", "time_period_impact", "symbol_impact", "event_impact", "sentiment_impact_gap"):
        one, other = getattr(cubes, name)(table), getattr(summaries, name)(matched)
        assert one.columns == other.columns
        for a, b in zip(rows(one), rows(other), strict=True):
            assert a == pytest.approx(b) or repr(a) == repr(b)
    stock = cleaning.clean_stock(t.stock().unionByName(t.stock().where("stockCode = 'S7'")))
    prices = cubes.stock_cube(stock, "S7")
    assert rows(cubes.stock_trend(prices)) == rows(cleaning.stock_trend(stock, "S7"))
    assert len(rows(cubes.daily_stock(prices))) == summaries.daily_stock(stock).count()


# --- summaries ----------------------------------------------------------------------------


def test_symbol_groups_mode_and_firsts(spark):
    df = pairs(
        spark, pair(1, "A", label="positive", name=None, day="2024-01-01"),
        pair(2, "A", label="negative", name="first", day="2024-01-02"),
        pair(3, "A", label="negative", name="later", day="2024-01-03"),
        pair(4, "B", label="positive"), pair(5, "B", label="neutral"), pair(6, None),
    )
    got = rows(summaries.symbol_groups(df), "stock_symbol", "news_sentiment", "stock_name")
    assert got == [("A", "negative", "first"), ("B", "neutral", "n")]


def test_empty_summaries(spark):
    empty = pairs(spark).limit(0)
    assert summaries.pair_label_counts(empty).first()["total_stock_news_pairs"] == 0
    assert stats.sentiment_price_corr(summaries.symbol_groups(empty)).first()[0] == 0.0
    assert stats.trend_line(empty).count() == 0
    assert feeds.symbol_topic_edges(empty).count() == 0
    assert rows(feeds.graph_nodes(empty), "type") == [("topic",)] * 5


def test_correlation_guards(spark):
    one = summaries.symbol_groups(pairs(spark, pair(1, "A", 0.5, 1.0)))
    assert stats.sentiment_price_corr(one).first()[0] == 0.0
    constant = summaries.symbol_groups(pairs(spark, pair(1, "A", 0.5, 1.0), pair(2, "B", 0.5, 2.0)))
    assert stats.sentiment_price_corr(constant).first()[0] is None
    exact = summaries.symbol_groups(pairs(spark, pair(1, "A", 0.5, 1.0), pair(2, "B", 1.0, 2.0)))
    assert stats.sentiment_price_corr(exact).first()[0] == 1.0


def test_gap_with_a_missing_side(spark):
    df = spark.createDataFrame([("POSITIVE", 0.5), ("NEUTRAL", 9.0)], "sentiment_label string, daily_return double")
    assert summaries.sentiment_impact_gap(df).first()[0] == 0.5


def test_source_impact_needs_two(spark):
    df = spark.createDataFrame(
        [("a", -1.0, 0.0), ("a", 3.0, 1.0), ("b", 9.0, 0.0), (None, 1.0, 1.0), (None, 1.0, 1.0)],
        "source string, daily_return double, sentiment_score double",
    )
    assert rows(summaries.source_impact(df)) == [("a", 2.0, 0.5, 2)]


def test_extremes_and_summary(spark):
    df = spark.createDataFrame(
        [("2", "positive", 0.5), ("1", "positive", 0.5), ("3", "negative", -0.5)],
        "post_id string, sentiment_label string, sentiment_score double",
    )
    assert rows(summaries.extreme_articles(df), "extreme", "post_id") == [
        ("most_negative", "3"), ("most_positive", "1")
    ]
    s = summaries.sentiment_summary(df).first()
    assert (s["positive_percentage"], s["average_sentiment_score"]) == (66.67, 0.1667)
    assert summaries.extreme_articles(df.limit(0)).count() == 0
    assert summaries.sentiment_summary(df.limit(0)).first()["positive_percentage"] is None


def test_news_summary_counts_null_symbols_as_none(spark):
    df = spark.createDataFrame([(["A", "B"],), ([],), (None,), (["A"],)], "stock_symbols array<string>")
    assert tuple(summaries.news_summary(df).first()) == (4, 2, 3, 2)
    assert rows(summaries.ticker_mentions(df, 1)) == [("A", 2)]


# --- rankings -----------------------------------------------------------------------------


def test_top_movers_breaks_ties_by_symbol(spark):
    df = spark.createDataFrame(
        [(s, s, c) for s, c in [("c", 1.0), ("a", 1.0), ("b", 1.0), ("n", None)]],
        "symbol string, name string, change_percent double",
    )
    got = rows(ranking.top_movers(df, 2), "symbol", "side")
    assert got == [("a", "gainer"), ("a", "loser"), ("b", "gainer"), ("b", "loser")]


def test_dedup_scopes(spark):
    df = spark.createDataFrame(
        [("A", 1, 1), ("A", 1, 2), ("A", 2, 3), ("B", 2, 4)], "symbol string, batch int, o int"
    )
    assert len(rows(ranking.dedup_symbols(df, ["o"], batch="batch"))) == 3
    assert rows(ranking.dedup_symbols(df, ["o"]), "symbol", "o") == [("A", 1), ("B", 4)]


# --- series -------------------------------------------------------------------------------


def days(symbol, n, price=lambda i: float(i + 1), start=0):
    first = dt.date(2024, 1, 1)
    return [
        pair(f"{symbol}{i}", symbol, score=i / 10, price=price(i), day=str(first + dt.timedelta(days=i + start)))
        for i in range(n)
    ]


def test_lags_need_eight_days(spark):
    df = pairs(spark, *days("A", 7), *days("B", 8), *days("C", 10))
    got = rows(timeseries.time_series_features(df).groupBy("stock_symbol").count())
    assert got == [("B", 1), ("C", 3)]
    last = timeseries.time_series_features(df).where("stock_symbol = 'B'").first()
    assert (last["sentiment_lag_1"], last["sentiment_lag_7"]) == (0.6, 0.0)
    assert last["price_change_5d"] == pytest.approx(8 / 3 - 1)
    steps = [i / (i - 1) - 1 for i in range(4, 9)]
    assert last["volatility_5d"] == pytest.approx(np.std(steps, ddof=1))


def test_zero_price_and_single_change(spark):
    df = pairs(spark, *days("A", 3, price=lambda i: float(i)))
    got = timeseries.rolling_volatility(timeseries.price_changes(timeseries.daily_symbol(df))).orderBy("date")
    assert [r["price_change_1d"] for r in got.collect()] == [None, None, 1.0]
    assert [r["volatility_5d"] for r in got.collect()] == [None, None, None]


def test_daily_takes_the_latest_price(spark):
    df = pairs(spark, pair(2, "A", price=5.0), pair(1, "A", price=9.0), pair(3, "A", price=None))
    assert timeseries.daily_symbol(df).first()["current_price"] == 5.0


def test_daily_without_volume_is_the_same_but_for_it(spark):
    df = pairs(spark, pair(2, "A", price=5.0), pair(1, "A", price=9.0), pair(3, "A", price=None), pair(4, "B", price=None))
    odd = spark.createDataFrame([("5", "A", "soon", 7.0), ("6", None, "2024-01-01", 7.0)], "news_id string, stock_symbol string, published_at string, current_price double")
    df = df.unionByName(odd, allowMissingColumns=True)
    whole, narrow = timeseries.daily_symbol(df), timeseries.daily_symbol(df, volume=False)
    assert narrow.columns == [c for c in whole.columns if c != "volume"]
    assert rows(narrow) == rows(whole, *narrow.columns)
    assert rows(narrow, "stock_symbol", "current_price", "news_count") == [("A", 5.0, 3), ("B", None, 1)]


def test_days_are_utc_and_bad_times_are_dropped(spark):
    df = pairs(spark, pair(1, "A", 0.5), pair(2, "C", 0.1))
    odd = [("3", "A", "", 9.0), ("4", "A", "soon", 9.0), ("5", "A", None, 9.0), ("6", "A", "2024-01-01T23:00:00-05:00", 1.0)]
    more = spark.createDataFrame(odd, "news_id string, stock_symbol string, published_at string, sentiment_score double")
    df = df.unionByName(more, allowMissingColumns=True)
    got = rows(timeseries.daily_symbol(df), "stock_symbol", "date", "sentiment_score")
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert got == [("A", first, 0.5), ("A", second, 1.0), ("C", first, 0.1)]
    assert len(rows(timeseries.sector_daily(df))) == 3


def test_guards_on_few_days_and_sectors(spark):
    series = timeseries.time_series_features(pairs(spark, *days("A", 11)))
    assert timeseries.market_daily(series).count() == 0
    assert timeseries.symbol_recent(series, "A").count() == 0
    longer = timeseries.time_series_features(pairs(spark, *days("A", 15)))
    assert timeseries.market_daily(longer).count() == 8
    recent = timeseries.symbol_recent(longer, "A", days=2).collect()
    assert [r["date"] for r in recent] == [dt.date(2024, 1, 14), dt.date(2024, 1, 15)]
    assert timeseries.sector_daily(pairs(spark, pair(1, "AAPL"), pair(2, "MSFT"))).count() == 0
    wide = timeseries.sector_heatmap(pairs(spark, pair(1, "AAPL", 0.5), pair(2, "C", 1.0)), ["2024-01-01", "2024-01-02"])
    assert rows(wide) == [("Finance", 1.0, None), ("Technology", 0.5, None)]


# --- quantiles ------------------------------------------------------------------------------


def check_quantiles(spark, frame, probabilities=(0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0), **options):
    df = spark.createDataFrame(frame)
    got = quantiles.quantiles(df, "v", probabilities, by=["g"], **options)
    found = {(r["g"], r["probability"]): r["quantile"] for r in got.collect()}
    want = {
        (g, p): np.quantile(part["v"].dropna(), p)
        for g, part in frame.dropna().groupby("g") for p in probabilities
    }
    assert found.keys() == want.keys()
    for key, value in want.items():
        assert found[key] == pytest.approx(value, rel=1e-12, abs=1e-12), key


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    frame = pd.DataFrame({
        "g": ["hot"] * 4000 + ["far"] * 501 + ["two"] * 2 + ["one"] + ["same"] * 9,
        "v": np.concatenate([
            np.where(rng.random(4000) < 0.33, 1.5, rng.normal(size=4000)),  # one value is a third
            np.append(rng.normal(size=500), 1e9),  # an outlier puts the rest in one cell
            [3.0, 8.0], [4.0], np.full(9, 2.25),
        ]),
    })
    check_quantiles(spark, frame)
    check_quantiles(spark, frame, cells=4, ordered=50)


@pytest.mark.parametrize("kind", ["lognormal", "outliers", "zeros", "close"])
def test_few_values_are_left_to_order(spark, monkeypatch, kind):
    """Whatever the spread of the values, the cells in question shrink in two rounds."""
    rng = np.random.default_rng(8)
    v = {
        "lognormal": rng.lognormal(0, 6, 30_000),
        "outliers": np.append(rng.normal(size=30_000), [1e6, 1e12, -1e9]),
        "zeros": np.append(rng.normal(size=20_000) * 1e-300, [0.0, 5.0, -5e-324]),
        "close": 1e9 + rng.random(20_000) * 1e-4,
    }[kind]
    rounds = []
    attach = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df: rounds.append(attach(df)) or rounds[-1])
    check_quantiles(spark, pd.DataFrame({"g": "all", "v": v}), ordered=200)
    slots = rounds[-1].groupBy("_slot").count().agg(F.max("count")).first()[0]
    assert slots <= 200 and len(rounds) <= 1 + 2 * 3


def test_box_of_everything_and_of_nothing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)] + [(None,), (-3.0,)], "pe_ratio double")
    assert tuple(feeds.pe_box(df).first()) == (5, 1.0, 2.0, 3.0, 4.0, 5.0)
    assert feeds.pe_box(df.where("pe_ratio = 1")).count() == 0
    assert feeds.pe_box(df.limit(0)).count() == 0


def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 9.9, 10.0, None)], "price double")
    got = rows(feeds.price_histogram(df, 2))
    assert got == [(0, 0.0, 5.0, 2), (1, 5.0, 10.0, 2)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "price double")
    assert [r[3] for r in rows(feeds.price_histogram(flat, 2))] == [2, 0]
    assert feeds.price_histogram(flat.limit(0)).count() == 0


# --- graph, report ----------------------------------------------------------------------------


def test_edges_take_the_latest_weight(spark):
    df = pairs(
        spark, pair(1, "A", 0.6, 2.0, day="2024-01-02"), pair(2, "A", 0.9, 2.0, day="2024-01-01"),
        pair(3, "B", -0.6, -2.0), pair(4, "C", -0.6, 2.0), pair(5, "D", 0.2, 2.0), pair(6, "E", 0.5, 1.0),
    )
    assert rows(feeds.symbol_topic_edges(df)) == [
        ("A", "high_sentiment", 0.6), ("A", "positive_performer", 0.6), ("B", "low_sentiment", 0.6),
        ("B", "negative_performer", 0.6), ("C", "low_sentiment", 0.6),
    ]
    assert len(rows(feeds.graph_nodes(df))) == 5 + 5


@pytest.mark.parametrize("c, accuracy, mood, texts", [
    (0.45, 0.61, "positive", {"correlation", "prediction", "strategy"}),
    (-0.35, 0.6, "negative", {"correlation"}), (0.3, 0.2, "neutral", {"correlation"}),
    (None, 0.2, "neutral", {"correlation"}),
])
def test_findings(spark, c, accuracy, mood, texts):
    df = pairs(spark, pair(1, "A"), pair(2, "A"))
    correlation = spark.createDataFrame([(c,)], "overall_correlation double")
    model = spark.createDataFrame([(accuracy, 7)], "classification_accuracy double, sample_size long")
    got = {r["item"]: r["text"] for r in stats.report_findings(df, correlation, model).collect()}
    assert got["market_sentiment"] == mood
    assert {"correlation", "prediction", "strategy"} & got.keys() == texts
    assert (got["stocks_analyzed"], got["news_articles"], got["prediction_sample_size"]) == ("1", "2", "7")
    assert f"({c or 0:.3f})" in got["correlation"]


def test_findings_write_the_correlation_as_the_sql_does(spark):
    """Halves of the last place by the binary value, and the sign of what rounds to zero."""
    values = [0.0045, -0.0135, 0.0125, 0.0625, 0.1875, 0.3125, 0.0005, -0.0004, -0.0, 0.0, 0.2995, -0.9995, 1.0, -1.0]
    values += [i / 10000 for i in range(-10000, 10001, 5)]
    df = spark.createDataFrame([(c,) for c in values], "c double")
    texts = df.select("c", stats.three_places(F.col("c")).alias("t")).collect()
    assert [r["t"] for r in texts] == [f"{r['c']:.3f}" for r in texts]
    groups = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.0, 1.0), (1.0, -1e-5)], "sentiment_score double, daily_change_percent double")
    correlation = stats.sentiment_price_corr(groups)
    assert str(correlation.first()[0]) == "-0.0"
    text = {r["item"]: r["text"] for r in stats.report_findings(pairs(spark, pair(1, "A")), correlation).collect()}
    assert "(-0.000)" in text["correlation"]


# --- scoring ------------------------------------------------------------------------------------


def test_model_scorer_survives_a_bad_row(spark):
    def load():
        def score(texts):
            if texts.str.contains("boom").any():
                raise RuntimeError("model failed")
            return pd.DataFrame({"label": ["positive"] * len(texts), "score": [0.123456] * len(texts)})

        return score

    df = spark.createDataFrame(
        [("1", "a long enough text", None), ("2", "a text that goes boom", None), ("3", "", "a headline, longer"), ("4", "short", None)],
        "post_id string, text_raw string, headline string",
    ).coalesce(1)
    scored = sentiment.score_articles(df, sentiment.model_scorer(load))
    assert rows(scored, "post_id", "sentiment_label", "sentiment_score") == [
        ("1", "positive", 0.1235), ("2", "neutral", 0.0), ("3", "positive", 0.1235), ("4", "neutral", 0.0)
    ]


def test_default_scorer(spark):
    df = spark.createDataFrame([("1", "record profit this year")], "post_id string, text_raw string")
    assert rows(sentiment.score_articles(df), "sentiment_label", "sentiment_score") == [("positive", 0.7)]


def test_digest_prefixes_repeated_names(spark):
    one = spark.createDataFrame([(1,)], "a int")
    got = feeds.daily_digest(one, one, one, spark.createDataFrame([(2,)], "b int"), one).first().asDict()
    assert got == {"a": 1, "stock_a": 1, "news_a": 1, "b": 2, "correlation_a": 1}
    assert json.dumps(got)
