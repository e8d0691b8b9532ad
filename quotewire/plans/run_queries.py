"""Queries of sources and sinks, statistics, models, streams and whole workflows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.operators import causality, clusters, models, stats, summaries, timeseries
from quotewire.operators.joins import integrate
from quotewire.operators.pages import build_chunks
from quotewire.operators.sentiment import lexicon_scorer, score_articles
from quotewire.plans import workflows
from quotewire.plans.catalog import query, rounded
from quotewire.plans.inputs import NEGATIVE, POSITIVE, SITE, Inputs, sql
from quotewire.plans.table_queries import (
    IMPACT_GAP,
    NEWS_VOLUME,
    PAIR_LABEL_COUNTS,
    RETURN_STATS,
    RUN_SUMMARY,
    SENTIMENT_DIST,
    SENTIMENT_RETURN,
    SENTIMENT_VS_RETURN,
    SOURCE_IMPACT,
    SYMBOL_IMPACT,
    TIME_PERIOD_IMPACT,
    TOP_SOURCES,
    match_sql,
    movers_sql,
)
from quotewire.schemas import struct_of
from quotewire.session import materialize, shared_folder
from quotewire.sources import readers, writers
from quotewire.streaming import daily as streams


def scratch(t: Inputs, name: str) -> str:
    """A new folder on the shared file system."""
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


SCORER = lexicon_scorer(POSITIVE, NEGATIVE)


# --- sources and sinks: written by Spark, then read back -------------------------------

_STOCK_DOUBLES = ("open", "high", "low", "close")
_STOCK = "SELECT stockCode, date, open, high, low, close, volume FROM stock"


@query("read_stock_csv", sql(rounded(_STOCK, *_STOCK_DOUBLES), "stock"))
def read_stock_csv(t: Inputs) -> DataFrame:
    path = scratch(t, "ohlc")
    columns = ["stockCode", "date", "open", "high", "low", "close", "volume"]
    writers.write_csv(t.stock().select(*columns), path)
    return readers.read_stock_csv(t.spark, f"{path}/*.csv")


@query("write_csv", sql(TOP_SOURCES, "clean_news"))
def write_csv(t: Inputs) -> DataFrame:
    path = scratch(t, "top_sources")
    writers.write_csv(workflows.full_workflow(t.news(), t.stock(), "S7")["top_sources"], path)
    return t.spark.read.schema("newsSource string, articleCount long").csv(path, header=True)


_POST_COLUMNS = "post_id, created_utc, created_iso, author, text_raw, url, source, headline"


@query("write_json", sql(f"SELECT {_POST_COLUMNS} FROM posts", "posts"))
def write_json(t: Inputs) -> DataFrame:
    path = scratch(t, "posts")
    posts = t.posts().select(*_POST_COLUMNS.split(", "))
    writers.write_json(posts, path)
    return readers.read_json_doc(t.spark, path, posts.schema, multi_line=False)


#: Posts of a document at most, as post ids do not repeat.
DOCUMENT_POSTS = 4000


@query("read_json_doc", sql("SELECT post_id, author, headline FROM posts", "posts"))
def read_json_doc(t: Inputs) -> DataFrame:
    """Indented documents, each a list of posts in a file of its own."""
    path = scratch(t, "documents")
    post = F.struct("post_id", "author", "headline")
    number = F.col("post_id").cast("long")
    listed = t.posts().groupBy(F.floor(number / DOCUMENT_POSTS).alias("file")).agg(
        F.to_json(F.collect_list(post), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")
    )
    listed.write.partitionBy("file").text(path)
    return readers.read_json_doc(t.spark, f"{path}/file=*", post_schema())


def post_schema() -> T.StructType:
    return struct_of(post_id=T.StringType(), author=T.StringType(), headline=T.StringType())


SNAPSHOT_ROW = struct_of(
    post_id=T.StringType(), headline=T.StringType(), chunk_idx=T.IntegerType(),
    clean_text=T.StringType(), symbol=T.StringType(), name=T.StringType(),
    change_percent=T.DoubleType(),
)


@query(
    "read_snapshots",
    sql(
        f"""SELECT post_id, headline, NULL AS chunk_idx, NULL AS clean_text, NULL AS symbol, NULL AS name,
            NULL AS change_percent FROM posts
        UNION ALL SELECT post_id, NULL, 0, text_raw, NULL, NULL, NULL FROM posts
        UNION ALL SELECT NULL, NULL, NULL, NULL, symbol, name, change_percent FROM part_quotes
        UNION ALL SELECT NULL, NULL, NULL, NULL, symbol, name, change_percent FROM quotes""",
        "posts", "part_quotes", "quotes",
    ),
)
def read_snapshots(t: Inputs) -> DataFrame:
    """Snapshots of three kinds: objects of posts and chunks, summaries, and lists."""
    folder = scratch(t, "snapshots")
    post = F.struct("post_id", "headline")
    chunk = F.struct("post_id", F.lit(0).alias("chunk_idx"), F.col("text_raw").alias("clean_text"))
    number = F.col("post_id").cast("long")
    crawls = t.posts().groupBy(F.floor(number / 20)).agg(
        F.to_json(F.struct(F.collect_list(post).alias("posts"), F.collect_list(chunk).alias("chunks")))
        .alias("value")
    )
    quote = F.struct("symbol", "name", "change_percent")
    movers = t.part_quotes().groupBy(F.floor(F.col("part_no") / 20)).agg(
        F.to_json(F.struct(
            F.filter(F.collect_list(quote), lambda q: q["change_percent"] > 0).alias("top_gainers"),
            F.filter(F.collect_list(quote), lambda q: q["change_percent"] <= 0).alias("top_losers"),
        )).alias("value")
    )
    lists = t.quotes().groupBy(F.floor(F.col("timestamp") / 20)).agg(
        F.to_json(F.collect_list(quote)).alias("value")
    )
    # one snapshot per line of text, as one file each would be for a crawl
    for kind, frame in (("crawls", crawls), ("movers", movers), ("lists", lists)):
        frame.select("value").write.option("lineSep", "\n").text(f"{folder}/{kind}")
    rows, _ = readers.read_snapshots(
        t.spark, f"{folder}/*", SNAPSHOT_ROW, pattern="*.txt", multi_line=False
    )
    return rows


@query(
    "write_result_tables",
    sql(rounded(SOURCE_IMPACT, "avg_abs_return", "avg_sentiment"), "matched"),
)
def write_result_tables(t: Inputs) -> DataFrame:
    folder = scratch(t, "results")
    tables = {
        "source_impact": summaries.source_impact(t.matched()),
        "empty": t.matched().where("symbol IS NULL"),
    }
    written = writers.write_result_tables(tables, folder)
    return t.spark.read.schema(
        "source string, avg_abs_return double, avg_sentiment double, news_count long"
    ).csv([f"{folder}/{name}" for name in written], header=True)


@query("write_stocks", sql(movers_sql(5), "part_quotes"))
def write_stocks(t: Inputs) -> DataFrame:
    folder = scratch(t, "stocks")
    writers.write_stocks(t.part_quotes(), folder)
    schema = T.StructType.fromDDL("symbol string, name string, change_percent double, side string")
    return readers.read_json_doc(t.spark, f"{folder}/top_movers", schema, multi_line=False)


@query("write_news", sql("SELECT post_id, 0 AS chunk_idx, text_raw AS clean_text FROM posts", "posts"))
def write_news(t: Inputs) -> DataFrame:
    folder = scratch(t, "news")
    posts = t.posts()
    writers.write_news(posts, build_chunks(posts, SITE), folder)
    schema = T.StructType.fromDDL("post_id string, chunk_idx int, clean_text string")
    return readers.read_json_doc(t.spark, f"{folder}/chunks", schema, multi_line=False)


@query("write_analysis", sql(PAIR_LABEL_COUNTS.format("post_pairs"), "post_pairs"))
def write_analysis(t: Inputs) -> DataFrame:
    folder = scratch(t, "analysis")
    pairs = materialize(integrate(t.quotes(), score_articles(t.posts(), SCORER)))
    sections = workflows.correlation_sections(pairs)
    writers.write_analysis(pairs, sections, folder)
    return readers.read_json_doc(
        t.spark, f"{folder}/correlations/pair_label_counts", sections["pair_label_counts"].schema,
        multi_line=False,
    )


# --- statistics and models --------------------------------------------------------------


def _series(t: Inputs) -> DataFrame:
    return timeseries.time_series_features(t.pairs("S"), volume=False)


def _model_series(t: Inputs, *more: Column) -> DataFrame:
    """What the models read of the series, written once; columns not named are never worked out."""
    return materialize(
        _series(t).select("stock_symbol", "date", *models.FEATURES, models.TARGET, *more)
    )


def _model_sides(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; the hash of the split is worked out as the series is written."""
    series = _model_series(t, models.in_train().alias("_train"))
    return models.train_test_split(models.model_frame(series), F.col("_train"))


def _granger_sql() -> str:
    """Least squares by eliminating one column after another from the sums of products.

    The chi-square tail is 1 - exp(-h) sum h^(a + n) / gamma(a + n + 1) with a = k / 2.
    """
    ctes = ["""complete AS (
        SELECT *, count(*) OVER (PARTITION BY stock_symbol) AS sample_size,
            row_number() OVER (PARTITION BY stock_symbol ORDER BY date) AS t
        FROM (SELECT stock_symbol, date, sentiment_score AS x, price_change_1d AS y,
                count(*) OVER (PARTITION BY stock_symbol) AS days FROM series)
        WHERE x IS NOT NULL AND y IS NOT NULL QUALIFY days >= 50 AND sample_size >= 20)""",
        # Deviations from the mean, or the sums would lose digits.
        """centred AS (
        SELECT stock_symbol, sample_size, t, x - avg(x) OVER (PARTITION BY stock_symbol) AS x,
            y - avg(y) OVER (PARTITION BY stock_symbol) AS y FROM complete)"""]
    last = []
    for k in range(1, causality.GRANGER_MAX_LAG + 1):
        lags = ", ".join(f"lag({c}, {i}) OVER w" for c in "yx" for i in range(1, k + 1))
        size = 2 * k + 2
        ctes.append(f"""rows_{k} AS (
            SELECT stock_symbol, sample_size, t, [y, 1.0, {lags}] AS v FROM centred
            WINDOW w AS (PARTITION BY stock_symbol ORDER BY t) QUALIFY t > {k})""")
        ctes.append(f"""g_{k}_0 AS (
            SELECT stock_symbol, any_value(sample_size) AS sample_size, a, b, sum(v[a] * v[b]) AS s
            FROM rows_{k}, range(1, {size + 1}) i(a), range(1, {size + 1}) j(b) GROUP BY stock_symbol, a, b)""")
        for n, p in enumerate(range(2, size + 1), 1):
            ctes.append(f"""g_{k}_{n} AS (
                SELECT g.stock_symbol, g.sample_size, g.a, g.b, g.s - l.s * r.s / c.s AS s FROM g_{k}_{n - 1} g
                JOIN g_{k}_{n - 1} l ON l.stock_symbol = g.stock_symbol AND l.a = g.a AND l.b = {p}
                JOIN g_{k}_{n - 1} r ON r.stock_symbol = g.stock_symbol AND r.a = {p} AND r.b = g.b
                JOIN g_{k}_{n - 1} c ON c.stock_symbol = g.stock_symbol AND c.a = {p} AND c.b = {p})""")
        ctes.append(f"""stat_{k} AS (
            SELECT o.stock_symbol, o.sample_size, (o.sample_size - {k}) * (o.s - f.s) / f.s AS stat_{k}
            FROM g_{k}_{k + 1} o JOIN g_{k}_{2 * k + 1} f USING (stock_symbol)
            WHERE o.a = 1 AND o.b = 1 AND f.a = 1 AND f.b = 1)""")
        ctes.append(f"""p_{k} AS (
            SELECT stock_symbol, sample_size, stat_{k}, CASE WHEN stat_{k} <= 0 THEN 1.0 ELSE 1 - s END AS lag_{k}
            FROM (SELECT stock_symbol, sample_size, stat_{k}, sum(exp(({k} / 2 + n) * ln(greatest(stat_{k}, 1e-300) / 2) - stat_{k} / 2
                    - lgamma({k} / 2 + n + 1))) AS s
                FROM stat_{k}, range(0, 1000) x(n) GROUP BY stock_symbol, sample_size, stat_{k}))""")
        last.append(f"p_{k}")
    ks = range(1, causality.GRANGER_MAX_LAG + 1)
    found = ", ".join(f"CASE WHEN lag_{k} < 0.05 THEN 'lag_{k}' END" for k in ks)
    numbers = [f"{c}_{k}" for k in ks for c in ("stat", "lag")]
    body = f"""SELECT stock_symbol, sample_size, {", ".join(numbers)}, concat_ws(',', {found}) AS significant_lags
        FROM {last[0]} {" ".join(f"JOIN {p} USING (stock_symbol, sample_size)" for p in last[1:])}"""
    views = sql("", "series").strip()
    return f"""{views}, {", ".join(ctes)} {rounded(body, *numbers)}"""


@query("granger", _granger_sql())
def granger(t: Inputs) -> DataFrame:
    return causality.granger(_series(t))


_COMPLETE = "volatility_5d IS NOT NULL AND price_change_1d IS NOT NULL"


@query(
    "model_frame",
    sql(
        rounded(
            f"""SELECT stock_symbol, date, sentiment_lag_7, volatility_5d, news_count, price_change_1d,
                CAST(price_change_1d > 0 AS BIGINT) AS price_direction
            FROM series WHERE {_COMPLETE} AND (SELECT count(*) FROM series) >= 100
                AND (SELECT count(*) FROM series WHERE {_COMPLETE}) >= 50""",
            "sentiment_lag_7", "volatility_5d", "price_change_1d",
        ),
        "series",
    ),
)
def model_frame(t: Inputs) -> DataFrame:
    return models.model_frame(_model_series(t)).select(
        "stock_symbol", "date", "sentiment_lag_7", "volatility_5d", "news_count",
        "price_change_1d", "price_direction",
    )


_FRAME = f"""
    SELECT *, CAST('0x' || substr(md5('42|' || stock_symbol || '|' || date), 1, 8) AS BIGINT) % 100 < 80
        AS in_train FROM series WHERE {_COMPLETE}"""


@query(
    "train_test_split",
    sql(
        f"""SELECT stock_symbol, date, CASE WHEN in_train THEN 'train' ELSE 'test' END AS side
        FROM ({_FRAME})""",
        "series",
    ),
)
def train_test_split(t: Inputs) -> DataFrame:
    train, test = _model_sides(t)
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    ).select("stock_symbol", "date", "side")


_SCALED = ", ".join(
    f"({c} - avg({c}) FILTER (WHERE in_train) OVER ()) / stddev_samp({c}) FILTER (WHERE in_train) OVER () AS {c}"
    for c in models.FEATURES
)


@query(
    "scale_features",
    sql(
        rounded(
            f"""SELECT stock_symbol, date, {", ".join(models.FEATURES)} FROM (
                SELECT stock_symbol, date, in_train, {_SCALED} FROM ({_FRAME})) WHERE NOT in_train""",
            *models.FEATURES,
        ),
        "series",
    ),
)
def scale_features(t: Inputs) -> DataFrame:
    train, test = _model_sides(t)
    _, scaled = models.scale_features(train, test)
    return models.scaled_values(scaled)


@query("predict_direction")
def predict_direction(t: Inputs) -> DataFrame:
    forest = models.predict_direction(*models.model_split(_model_series(t)))
    return forest.predictions.select(
        "stock_symbol", "date", "price_direction", "predicted_direction"
    )


@query("predict_magnitude")
def predict_magnitude(t: Inputs) -> DataFrame:
    forest = models.predict_magnitude(*models.model_split(_model_series(t)))
    return forest.predictions.select("stock_symbol", "date", "price_change_1d", "predicted_change")


@query("feature_importance")
def feature_importance(t: Inputs) -> DataFrame:
    return models.build_prediction_models(_model_series(t)).feature_importance


@query("kmeans_elbow")
def kmeans_elbow(t: Inputs) -> DataFrame:
    return clusters.kmeans_elbow(summaries.cluster_features(t.pairs()))


@query("kmeans_symbols")
def kmeans_symbols(t: Inputs) -> DataFrame:
    return clusters.kmeans_symbols(summaries.cluster_features(t.pairs()))


@query("cluster_profile")
def cluster_profile(t: Inputs) -> DataFrame:
    return clusters.cluster_profile(clusters.kmeans_symbols(summaries.cluster_features(t.pairs())))


_Z_SQL = ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}_z" for c in clusters.CLUSTER_FEATURES
)


@query(
    "kmeans_settled",
    sql(
        rounded(
            f"""SELECT stock_symbol, {_Z_SQL}, true AS nearest, true AS settled FROM (
                SELECT stock_symbol, avg(sentiment_score) AS sentiment_score,
                    avg(daily_change_percent) AS daily_change_percent, count(*) AS news_count
                FROM pairs GROUP BY stock_symbol)""",
            *[f"{c}_z" for c in clusters.CLUSTER_FEATURES],
        ),
        "pairs",
    ),
)
def kmeans_settled(t: Inputs) -> DataFrame:
    """What must hold of clusters: every symbol is nearest to the mean of its own.

    ``nearest`` compares a symbol with the means of all clusters, worked out from the
    members; ``settled`` that there are four and the fit's inertia is that of its members.
    """
    points = materialize(clusters.scaled_cluster_features(summaries.cluster_features(t.pairs())))
    fits = clusters.fit(points, [clusters.CLUSTERS], restarts=1, tolerance=0.0)
    members = clusters.assigned(points, fits.centres[clusters.CLUSTERS])
    z = [f"{c}_z" for c in clusters.CLUSTER_FEATURES]
    means = members.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in z])
    listed = means.agg(F.collect_list(F.struct("cluster", *z))).scalar()  # four of them
    away = lambda m: sum((F.col(c) - m[c]) ** 2 for c in z)
    told = members.withColumn("_means", listed)
    own = F.filter("_means", lambda m: m["cluster"] == F.col("cluster"))[0]
    told = told.withColumns({
        "_own": away(own), "_least": F.array_min(F.transform("_means", away)), "_n": F.size("_means")
    })
    total = told.agg(F.sum("_own")).scalar()
    settled = (F.col("_n") == clusters.CLUSTERS) & (F.abs(total - fits.inertia[clusters.CLUSTERS]) < 1e-6 * total)
    return told.select(
        "stock_symbol", *z, (F.col("_own") <= F.col("_least") + 1e-9).alias("nearest"), settled.alias("settled")
    )


# --- models of frames whose answer is known ----------------------------------------------


def _told_series(t: Inputs) -> DataFrame:
    """One feature settles the next move; all others are constant."""
    k = F.col("p_partkey")
    told = F.pmod(k, F.lit(7))
    constants = {c: F.lit(0.5) for c in models.FEATURES if c not in ("sentiment_lag_1", "news_count")}
    return t.table("part").select(
        F.concat(F.lit("P"), F.pmod(k, F.lit(50))).alias("stock_symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.floor(k / 50).cast("int")).alias("date"),
        ((told - 3) / 4).alias("sentiment_lag_1"),
        *[c.alias(name) for name, c in constants.items()],
        F.lit(3).cast("long").alias("news_count"),
        F.when(told > 3, 0.02).otherwise(-0.01).alias(models.TARGET),
    )


_TOLD = """
    SELECT * FROM (
        SELECT *, CAST('0x' || substr(md5('42|' || stock_symbol || '|' || date), 1, 8) AS BIGINT) % 100 < 80
            AS in_train FROM (
            SELECT 'P' || (p_partkey % 50) AS stock_symbol, p_partkey % 7 > 3 AS up,
                strftime(DATE '2024-01-01' + CAST(p_partkey // 50 AS INTEGER), '%Y-%m-%d') AS date FROM part))
    WHERE NOT in_train"""


@query(
    "predict_direction_told",
    f"""SELECT stock_symbol, date, CAST(up AS BIGINT) AS price_direction,
        CAST(up AS DOUBLE) AS predicted_direction FROM ({_TOLD})""",
)
def predict_direction_told(t: Inputs) -> DataFrame:
    forest = models.predict_direction(*models.model_split(_told_series(t)))
    return forest.predictions.select("stock_symbol", "date", "price_direction", "predicted_direction")


@query(
    "predict_magnitude_told",
    rounded(
        f"""SELECT stock_symbol, date, CASE WHEN up THEN 0.02 ELSE -0.01 END::DOUBLE AS price_change_1d,
            CASE WHEN up THEN 0.02 ELSE -0.01 END::DOUBLE AS predicted_change FROM ({_TOLD})""",
        "price_change_1d", "predicted_change",
    ),
)
def predict_magnitude_told(t: Inputs) -> DataFrame:
    forest = models.predict_magnitude(*models.model_split(_told_series(t)))
    return forest.predictions.select("stock_symbol", "date", "price_change_1d", "predicted_change")


@query(
    "feature_importance_told",
    f"""SELECT unnest({list(models.FEATURES)}) AS feature,
        unnest({[float(c == "sentiment_lag_1") for c in models.FEATURES]})::DOUBLE AS importance_classification,
        unnest({[float(c == "sentiment_lag_1") for c in models.FEATURES]})::DOUBLE AS importance_regression
    WHERE (SELECT count(*) FROM part) >= 100""",
)
def feature_importance_told(t: Inputs) -> DataFrame:
    return models.build_prediction_models(_told_series(t)).feature_importance


def _banded_features(t: Inputs) -> DataFrame:
    """Symbols in four bands that lie far apart."""
    k = F.col("p_partkey")
    band = F.pmod(k, F.lit(4))
    step = F.pmod(F.floor(k / 4), F.lit(5))
    return t.table("part").select(
        F.concat(F.lit("P"), k).alias("stock_symbol"),
        (F.when(band % 2 == 0, -1.0).otherwise(1.0) + step / 1024).alias("sentiment_score"),
        (F.when(band < 2, -5.0).otherwise(5.0) + step / 256).alias("daily_change_percent"),
        F.when(band.isin(0, 3), 10).otherwise(90).cast("long").alias("news_count"),
        F.lit(1.0).alias("current_price"),
    )


_BANDED = """
    SELECT p_partkey % 4 AS band, 'P' || p_partkey AS stock_symbol,
        CASE WHEN p_partkey % 2 = 0 THEN -1.0 ELSE 1.0 END::DOUBLE + p_partkey // 4 % 5 / 1024 AS sentiment_score,
        CASE WHEN p_partkey % 4 < 2 THEN -5.0 ELSE 5.0 END::DOUBLE + p_partkey // 4 % 5 / 256 AS daily_change_percent,
        CAST(CASE WHEN p_partkey % 4 IN (0, 3) THEN 10 ELSE 90 END AS BIGINT) AS news_count FROM part"""
_BANDED_Z = ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z{i}" for i, c in enumerate(clusters.CLUSTER_FEATURES)
)


@query(
    "kmeans_symbols_bands",
    f"SELECT stock_symbol, min(stock_symbol) OVER (PARTITION BY band) AS first_member FROM ({_BANDED})",
)
def kmeans_symbols_bands(t: Inputs) -> DataFrame:
    found = clusters.kmeans_symbols(_banded_features(t)).select("stock_symbol", "cluster")
    first = found.groupBy("cluster").agg(F.min("stock_symbol").alias("first_member"))
    return found.join(first, "cluster").drop("cluster")


_PROFILE = ("avg_sentiment", "avg_performance", "avg_news_count")


@query(
    "cluster_profile_bands",
    rounded(
        f"""SELECT count(*) AS count, avg(sentiment_score) AS avg_sentiment,
            avg(daily_change_percent) AS avg_performance, avg(news_count) AS avg_news_count
        FROM ({_BANDED}) GROUP BY band""",
        *_PROFILE,
    ),
)
def cluster_profile_bands(t: Inputs) -> DataFrame:
    return clusters.cluster_profile(clusters.kmeans_symbols(_banded_features(t))).drop("cluster")


@query(
    "kmeans_elbow_bands",
    rounded(
        f"""SELECT 4 AS k, sum((z0 - m0) ** 2 + (z1 - m1) ** 2 + (z2 - m2) ** 2) AS inertia FROM (
            SELECT z0, z1, z2, avg(z0) OVER (PARTITION BY band) AS m0, avg(z1) OVER (PARTITION BY band) AS m1,
                avg(z2) OVER (PARTITION BY band) AS m2 FROM (SELECT band, {_BANDED_Z} FROM ({_BANDED})))""",
        "inertia",
    ),
)
def kmeans_elbow_bands(t: Inputs) -> DataFrame:
    """The inertia at the right number of clusters, which has a closed form."""
    return clusters.kmeans_elbow(_banded_features(t), ks=(clusters.CLUSTERS,))


_FINDINGS = f"""
    SELECT count(DISTINCT stock_symbol) AS stocks, count(*) AS articles,
        (SELECT round(covar_pop(s, d) / nullif(stddev_pop(s) * stddev_pop(d), 0), 4) FROM (
            SELECT avg(sentiment_score) AS s, avg(daily_change_percent) AS d
            FROM pairs GROUP BY stock_symbol)) AS c FROM pairs"""


def _shown_sql(template: str) -> str:
    """A text with the correlation in its place."""
    return "'" + template.replace("%.3f", "' || format('{:.3f}', c) || '") + "'"


_ENTRIES = [
    ("sample_size", "stocks_analyzed", "CAST(stocks AS VARCHAR)"),
    ("sample_size", "news_articles", "CAST(articles AS VARCHAR)"),
    ("sample_size", "prediction_sample_size", "'0'"),
    ("executive_summary", "market_sentiment",
     "CASE WHEN c > 0.3 THEN 'positive' WHEN c < -0.3 THEN 'negative' ELSE 'neutral' END"),
    ("key_findings", "correlation",
     f"""CASE WHEN c > 0.3 THEN {_shown_sql(stats.STRONG_POSITIVE_TEXT)}
         WHEN c < -0.3 THEN {_shown_sql(stats.STRONG_NEGATIVE_TEXT)} ELSE {_shown_sql(stats.WEAK_TEXT)} END"""),
    ("trading_strategies", "strategy",
     f"CASE WHEN c > 0.4 THEN '{stats.MOMENTUM_TEXT}' WHEN c < -0.4 THEN '{stats.CONTRARIAN_TEXT}' END"),
    ("monitoring_alerts", "alert", f"'{stats.MONITORING_TEXT}'"),
    ("research_directions", "direction", f"'{stats.RESEARCH_TEXT}'"),
]


@query(
    "report_findings",
    sql(
        " UNION ALL ".join(
            f"SELECT '{section}' AS section, '{item}' AS item, {text} AS text FROM ({_FINDINGS}) WHERE {text} IS NOT NULL"
            for section, item, text in _ENTRIES
        ),
        "pairs",
    ),
)
def report_findings(t: Inputs) -> DataFrame:
    pairs = t.pairs()
    correlation = stats.sentiment_price_corr(summaries.symbol_groups(pairs))
    return stats.report_findings(pairs, correlation)


# --- streams ----------------------------------------------------------------------------


def _events(t: Inputs) -> DataFrame:
    schema = t.spark.read.parquet(t.path("events")).schema
    # a pattern, because a stream takes no path of a single file
    files = f"{t.folder}/event[s].parquet"
    return streams.stream_ingest(t.spark, files, schema, format="parquet")


def _drained(t: Inputs, stream: DataFrame, name: str) -> DataFrame:
    return streams.run_available(stream, scratch(t, name), scratch(t, f"{name}-progress"))


@query(
    "stream_ingest",
    rounded(
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value FROM events",
        "value",
    ),
)
def stream_ingest(t: Inputs) -> DataFrame:
    rows = streams.event_time(_events(t), "ts").select("event_id", "ts", "event_type", "value")
    return _drained(t, rows, "ingest")


@query(
    "stream_dedup",
    # Times count in sixteenths of the five days, from 1970 on.
    """WITH RECURSIVE times AS (SELECT DISTINCT 'S' || user_id AS symbol, epoch_ms(ts) // 27000000 AS slice FROM events),
    kept AS (
        SELECT symbol, min(slice) AS slice FROM times GROUP BY symbol
        UNION ALL
        SELECT k.symbol, min(t.slice) FROM kept k JOIN times t ON t.symbol = k.symbol AND t.slice >= k.slice + 16
        GROUP BY k.symbol, k.slice)
    SELECT symbol, count(*) AS arrivals FROM kept GROUP BY symbol""",
)
def stream_dedup(t: Inputs) -> DataFrame:
    """How often each user comes back after five days or more."""
    keyed = _events(t).select(F.concat(F.lit("S"), "user_id").alias("symbol"), "ts")
    deduped = streams.stream_dedup(keyed, ["symbol"], "ts", delay="5 days")
    return _drained(t, deduped, "dedup").groupBy("symbol").agg(F.count("*").alias("arrivals"))


@query(
    "stream_daily_counts",
    rounded(
        """SELECT strftime(ts, '%Y-%m-%d') AS date, event_type, count(*) AS "count", avg(value) AS mean
        FROM events GROUP BY ALL""",
        "mean",
    ),
)
def stream_daily_counts(t: Inputs) -> DataFrame:
    """All days of the backlog, those still open at its end too."""
    counts = streams.stream_daily_counts(_events(t), "ts", ["event_type"], "value")
    return streams.upsert_available(
        counts, ["date", "event_type"], scratch(t, "counts"), scratch(t, "counts-progress")
    )


# --- whole workflows: their tables as rows (section, item, measure, value) ---------------


def _long(section: str, df: DataFrame, item: str | None, *measures: str) -> DataFrame:
    """Numbers of a result table as rows."""
    values = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(f"`{m}`").cast("double").alias("value"))
        for m in measures
    ])
    key = F.lit("") if item is None else F.col(item).cast("string")
    return df.select(F.lit(section).alias("section"), key.alias("item"), F.inline(values))


def _long_sql(section: str, body: str, item: str | None, *measures: str) -> str:
    key = "''" if item is None else f"CAST({item} AS VARCHAR)"
    return " UNION ALL ".join(
        f"""SELECT '{section}' AS section, {key} AS item, '{m}' AS measure,
            CAST("{m}" AS DOUBLE) AS value FROM ({body})""" for m in measures
    )


def _sections_sql(*sections: tuple) -> str:
    return rounded(" UNION ALL ".join(_long_sql(*s) for s in sections), "value")


def _sections(tables: workflows.Tables, *sections: tuple) -> DataFrame:
    out = None
    for section, item, *measures in sections:
        rows = _long(section, tables[section], item, *measures)
        out = rows if out is None else out.unionByName(rows)
    return out


_RETURN_MEASURES = ("avgReturn(%)", "stdReturn(%)", "maxReturn(%)", "minReturn(%)")


@query(
    "full_workflow",
    sql(
        _sections_sql(
            ("top_sources", TOP_SOURCES, "newsSource", "articleCount"),
            ("sentiment_dist", SENTIMENT_DIST, "sentimentLevel", "count", "percentage(%)"),
            ("return_stats", RETURN_STATS, None, *_RETURN_MEASURES),
            ("stock_trend", "SELECT date, close FROM clean_stock WHERE stockCode = 'S7'", "date", "close"),
            ("sentiment_vs_return", SENTIMENT_VS_RETURN, "sentimentType", "avgReturn(%)", "dayCount"),
        ),
        "joined",
    ),
)
def full_workflow(t: Inputs) -> DataFrame:
    return _sections(
        workflows.full_workflow(t.news(), t.stock(), "S7"),
        ("top_sources", "newsSource", "articleCount"),
        ("sentiment_dist", "sentimentLevel", "count", "percentage(%)"),
        ("return_stats", None, *_RETURN_MEASURES),
        ("stock_trend", "date", "close"),
        ("sentiment_vs_return", "sentimentType", "avgReturn(%)", "dayCount"),
    )


@query("simple_news", sql(rounded(SENTIMENT_DIST, "percentage(%)"), "clean_news"))
def simple_news(t: Inputs) -> DataFrame:
    path = scratch(t, "simple_sentiment_dist")
    writers.write_csv(workflows.simple_news(t.news()), path)
    return t.spark.read.schema(
        "sentimentLevel string, `count` long, `percentage(%)` double"
    ).csv(path, header=True)


_RUN_MEASURES = (
    "stocks_crawled", "news_articles_crawled", "articles_with_sentiment", "stock_news_integrations",
)
_LABEL_MEASURES = (
    "total_stock_news_pairs", "unique_stocks_analyzed", "positive", "negative", "neutral",
)


@query(
    "base_workflow",
    sql(
        _sections_sql(
            ("run_summary", RUN_SUMMARY, None, *_RUN_MEASURES),
            ("pair_label_counts", PAIR_LABEL_COUNTS.format("post_pairs"), None, *_LABEL_MEASURES),
            (
                "top_performers",
                """SELECT stock_symbol, avg(daily_change_percent) AS daily_change_percent,
                    avg(sentiment_score) AS sentiment_score FROM post_pairs GROUP BY 1
                ORDER BY 2 DESC, 1 LIMIT 10""",
                "stock_symbol", "daily_change_percent", "sentiment_score",
            ),
            (
                "label_shares",
                'SELECT sentiment_label AS label, count(*) AS "count" FROM scored GROUP BY 1',
                "label", "count",
            ),
        ),
        "post_pairs",
    ),
)
def base_workflow(t: Inputs) -> DataFrame:
    return _sections(
        workflows.base_workflow(t.quotes(), t.posts(), SCORER),
        ("run_summary", None, *_RUN_MEASURES),
        ("pair_label_counts", None, *_LABEL_MEASURES),
        ("top_performers", "stock_symbol", "daily_change_percent", "sentiment_score"),
        ("label_shares", "label", "count"),
    )


@query("research_workflow")
def research_workflow(t: Inputs) -> DataFrame:
    research = workflows.research_workflow(t.pairs("S"))
    return _sections(
        research.tables,
        ("market_daily", "date", "sentiment_score", "news_count"),
        ("top_mentioned_stocks", "stock_symbol", "mentions"),
        ("granger", "stock_symbol", "sample_size", "lag_1", "lag_5"),
        ("cluster_profile", "cluster", "count", "avg_sentiment"),
        ("model_results", None, "classification_accuracy", "regression_mse", "sample_size"),
        ("feature_importance", "feature", "importance_classification", "importance_regression"),
    )


_MATCHED = match_sql("INNER")


def _of_matched(body: str) -> str:
    return f"WITH matched AS ({_MATCHED}) {body}"


@query(
    "correlation_report",
    sql(
        _sections_sql(
            ("sentiment_return", _of_matched(SENTIMENT_RETURN), "sentiment_label", "avg_return", "sample_count"),
            ("volume_analysis", _of_matched(NEWS_VOLUME), "symbol || ' ' || news_date", "daily_news_count"),
            ("source_impact", _of_matched(SOURCE_IMPACT), "source", "avg_abs_return", "avg_sentiment", "news_count"),
            ("time_period_analysis", _of_matched(TIME_PERIOD_IMPACT.replace("hour(news_time)", "hour(CAST(news_time AS TIMESTAMP))")), "time_period", "avg_abs_return", "sample_count"),
            ("symbol_analysis", _of_matched(SYMBOL_IMPACT), "symbol", "avg_sentiment", "avg_return"),
            ("sentiment_impact_gap", _of_matched(IMPACT_GAP), None, "overall_sentiment_impact"),
            (
                "totals",
                f"""SELECT (SELECT count(DISTINCT symbol) FROM quotes) AS total_stocks_analyzed,
                    (SELECT count(*) FROM posts WHERE len(stock_symbols) > 0) AS total_news_articles,
                    (SELECT count(*) FROM ({_MATCHED})) AS total_matches""",
                None, "total_stocks_analyzed", "total_news_articles", "total_matches",
            ),
        ),
        "lexicon", "quotes",
    ),
)
def correlation_report(t: Inputs) -> DataFrame:
    quotes = t.quotes().withColumn("created_iso", F.lit("2024-01-02"))
    tables = workflows.correlation_report(
        t.posts(), quotes, ["name"], {"positive": POSITIVE, "negative": NEGATIVE}
    )
    days = tables["volume_analysis"]
    tables["volume_analysis"] = days.withColumn(
        "day", F.concat_ws(" ", "symbol", F.date_format("news_date", "yyyy-MM-dd"))
    )
    return _sections(
        tables,
        ("sentiment_return", "sentiment_label", "avg_return", "sample_count"),
        ("volume_analysis", "day", "daily_news_count"),
        ("source_impact", "source", "avg_abs_return", "avg_sentiment", "news_count"),
        ("time_period_analysis", "time_period", "avg_abs_return", "sample_count"),
        ("symbol_analysis", "symbol", "avg_sentiment", "avg_return"),
        ("sentiment_impact_gap", None, "overall_sentiment_impact"),
        ("totals", None, "total_stocks_analyzed", "total_news_articles", "total_matches"),
    )
