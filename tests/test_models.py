import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from quotewire.operators import causality, clusters, forests, models


# --- Granger ------------------------------------------------------------------------------


@pytest.mark.parametrize("df, point", [(1, 3.841459), (2, 5.991465), (3, 7.814728), (4, 9.487729), (5, 11.070498)])
def test_chi2_tail_at_known_points(one, df, point):
    tail = lambda x: one(lambda c: causality.chi2_tail(c, df), x)
    assert tail(point) == pytest.approx(0.05, abs=1e-6)
    assert tail(0.0) == tail(-1e-9) == 1.0
    assert tail(1e-12) == pytest.approx(1) and 0 < tail(600.0) < 1e-100
    # against the integral of the density
    x = np.linspace(point, point + 200, 400_001)
    density = x ** (df / 2 - 1) * np.exp(-x / 2) / (2 ** (df / 2) * math.gamma(df / 2))
    assert np.trapezoid(density, x) == pytest.approx(0.05, abs=1e-5)


def test_erfc_against_the_library(spark):
    x = np.concatenate([np.linspace(0, 3, 61), np.linspace(3.5, 20, 30)])
    got = spark.createDataFrame([(float(v),) for v in x], "x double").select("x", causality.erfc(F.col("x")).alias("e"))
    for v, e in got.collect():
        assert e == pytest.approx(math.erfc(v), rel=1e-12)


def chi2(stat, df):
    """The tail by the sum of the series of the incomplete gamma function."""
    h, a = stat / 2, df / 2
    return 1 - sum(math.exp((a + n) * math.log(h) - h - math.lgamma(a + n + 1)) for n in range(4000))


def squared_error(columns, target):
    """Residual sum of squares by the normal equations, column by column."""
    a = np.array(columns + [np.ones(len(target))])
    beta = np.linalg.solve(a @ a.T, a @ target)
    return float(((target - beta @ a) ** 2).sum())


def by_hand(y, x, k):
    n = len(y) - k
    own = [np.array([y[t - i] for t in range(k, len(y))]) for i in range(1, k + 1)]
    other = [np.array([x[t - i] for t in range(k, len(y))]) for i in range(1, k + 1)]
    restricted = squared_error(own, y[k:])
    full = squared_error(own + other, y[k:])
    return n * (restricted - full) / full


def series(spark, **symbols):
    out = []
    for symbol, (x, y) in symbols.items():
        for i, (a, b) in enumerate(zip(x, y)):
            day = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            out.append((symbol, day, None if a is None else float(a), None if b is None else float(b)))
    return spark.createDataFrame(
        out, "stock_symbol string, date date, sentiment_score double, price_change_1d double"
    )


def test_granger_against_normal_equations(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=120)
    y = 0.8 * np.roll(x, 2) + rng.normal(size=120) * 0.3
    z = rng.normal(size=120)
    df = series(
        spark,
        LED=(x, y), FREE=(x, z),
        FEW=(x[:49], z[:49]),  # under 50 rows
        GAPS=(x[:60], [None] * 41 + list(z[:19])),  # under 20 complete rows
        FLAT=(np.ones(60), z[:60]),  # a constant lag column
    )
    got = {r["stock_symbol"]: r for r in causality.granger(df).collect()}
    assert got.keys() == {"LED", "FREE"}
    for symbol, target in (("LED", y), ("FREE", z)):
        for k in range(1, 6):
            stat = by_hand(target, x, k)
            assert got[symbol][f"stat_{k}"] == pytest.approx(stat, rel=1e-9)
            assert got[symbol][f"lag_{k}"] == pytest.approx(chi2(stat, k), abs=1e-9)
    assert got["LED"]["sample_size"] == 120
    assert "lag_2" in got["LED"]["significant_lags"]
    for r in got.values():
        assert r["significant_lags"] == [f"lag_{k}" for k in range(1, 6) if r[f"lag_{k}"] < 0.05]


def test_granger_perfect_fit_is_left_out(spark):
    x = np.sin(np.arange(60.0))
    assert causality.granger(series(spark, A=(x, np.roll(x, 1)))).count() == 0


def test_granger_of_far_means_dependent_lags_and_other_lag_counts(spark):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=80), rng.normal(size=80)
    echo = np.roll(y, 1)  # each lag of the cause is a later lag of the effect
    echo[0] = 0.3
    df = series(spark, FAR=(1e6 + x, 1e-4 * y - 50), NEAR=(x, y), ECHO=(echo, y), **{"NAN": ([float("nan")] * 5 + list(x[5:]), y)})
    got = {r["stock_symbol"]: r for r in causality.granger(df, max_lag=3).collect()}
    assert got.keys() == {"FAR", "NEAR", "ECHO", "NAN"} and "lag_4" not in got["NEAR"].asDict()
    for k in range(1, 4):
        assert got["FAR"][f"stat_{k}"] == pytest.approx(got["NEAR"][f"stat_{k}"], rel=1e-6)
        assert got["NAN"][f"stat_{k}"] == pytest.approx(by_hand(y[5:], x[5:], k), rel=1e-9)
    # At 1 lag the echo is the same column but for its first value; what is left of it is tested.
    assert all(0 <= got["ECHO"][f"lag_{k}"] <= 1 for k in range(1, 4))


def test_granger_takes_one_shuffle_and_no_python(spark):
    df = series(spark, A=(np.arange(60.0) % 7, np.arange(60.0) % 5))
    plan = causality.granger(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_granger_puts_rows_in_order_once_and_is_compiled(spark):
    """One sort for all windows, and an aggregation of no more columns than Spark compiles."""
    rng = np.random.default_rng(6)
    df = series(spark, A=(rng.normal(size=60), rng.normal(size=60)))
    text = causality.granger(df)._jdf.queryExecution().executedPlan().toString()
    assert text.count("- Sort [") + text.count(") Sort [") == 1 and text.count("Window [") == 2
    sums = causality._products(df, "sentiment_score", "price_change_1d", 5, [
        "y_0", "one", *[f"{c}_{i}" for c in "yx" for i in range(1, 6)]])
    grouped = sums._jdf.queryExecution().analyzed().child()
    while grouped.getClass().getSimpleName() != "Aggregate":
        grouped = grouped.children().apply(0)
    assert grouped.output().size() <= int(spark.conf.get("spark.sql.codegen.maxFields"))


# --- forests ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def long_series(spark):
    rng = np.random.default_rng(5)
    n = 600
    frame = pd.DataFrame({f: rng.normal(size=n) for f in models.FEATURES})
    frame["news_count"] = rng.integers(1, 9, n)
    frame[models.TARGET] = frame["sentiment_lag_1"] + rng.normal(size=n) * 0.1
    frame["stock_symbol"] = [f"S{i % 6}" for i in range(n)]
    frame["date"] = [dt.date(2024, 1, 1) + dt.timedelta(days=i // 6) for i in range(n)]
    frame.loc[0, "volatility_5d"] = None
    frame = frame.astype({"volatility_5d": float})
    return spark.createDataFrame(frame).replace(float("nan"), None)


def test_model_frame_needs_enough_rows(spark, long_series):
    assert models.model_frame(long_series).count() == 599
    assert models.model_frame(long_series.limit(99)).count() == 0
    gaps = long_series.withColumn(
        "volatility_5d", F.when(F.col("date") < "2024-01-08", F.col("volatility_5d"))
    )
    assert models.model_frame(gaps).count() == 0
    assert models.build_prediction_models(gaps) is None


def test_split_is_stable_and_scaling_uses_train_only(long_series):
    frame = models.model_frame(long_series)
    train, test = models.train_test_split(frame)
    assert train.count() + test.count() == 599
    assert 0.7 < train.count() / 599 < 0.9
    again, _ = models.train_test_split(frame.repartition(7))
    assert rows(again, "stock_symbol", "date") == rows(train, "stock_symbol", "date")
    scaled, _ = models.scale_features(train, test)
    values = models.scaled_values(scaled).select(*models.FEATURES).toPandas()
    assert np.allclose(values.mean(), 0, atol=1e-9)
    assert np.allclose(values.std(ddof=1), 1)


def test_forests(long_series):
    a = models.build_prediction_models(long_series, trees=20)
    b = models.build_prediction_models(long_series, trees=20)
    assert a.results.first() == b.results.first()
    r = a.results.first()
    assert r["sample_size"] == r["train_size"] + r["test_size"] == 599
    assert r["classification_accuracy"] > 0.8 and r["regression_mse"] < 0.5
    importance = a.feature_importance.toPandas()
    assert importance["feature"][0] == "sentiment_lag_1"
    assert importance["importance_classification"].sum() == pytest.approx(1)
    assert importance["importance_regression"].sum() == pytest.approx(1)
    shown = a.classifier.predictions.select(
        F.avg((F.col("price_direction") == F.col("predicted_direction")).cast("int"))
    ).first()[0]
    assert shown == pytest.approx(r["classification_accuracy"])


def test_forests_of_a_written_series_count_its_rows_once_and_copy_none(long_series, monkeypatch):
    """Both forests share bins and counts; no row of the series is written again."""
    plain = models.build_prediction_models(long_series, trees=20)
    written, binned = [], []
    write, edges = models.materialize, forests.bin_edges
    monkeypatch.setattr(models, "materialize", lambda df: written.append(df.columns) or write(df))
    monkeypatch.setattr(forests, "bin_edges", lambda *a: binned.append(a) or edges(*a))
    marked = long_series.withColumn("_train", models.in_train())
    own = models.build_prediction_models(marked, trees=20, side=F.col("_train"))
    assert written == [["_train", "code", "y", "n"]] and len(binned) == 1
    assert own.results.first() == pytest.approx(plain.results.first())
    for forest in (own.classifier, own.regressor):
        assert forest.score == pytest.approx(forest.predictions.agg(F.avg(forest.measure)).first()[0])
    assert "_train" not in own.regressor.predictions.columns
    few = marked.withColumn("volatility_5d", F.when(F.col("date") < "2024-01-08", F.col("volatility_5d")))
    for short in (few, marked.limit(99), marked.withColumn("_train", F.lit(True))):
        assert models.build_prediction_models(short, side=F.col("_train")) is None


# --- clusters -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(9)
    centres = [(-1, -5, 10), (1, 5, 10), (-1, 5, 90), (1, -5, 90)]
    out = [
        (f"S{c}{i}", s + rng.normal() * 0.01, d + rng.normal() * 0.01, n, 1.0)
        for c, (s, d, n) in enumerate(centres) for i in range(10 + c)
    ]
    return spark.createDataFrame(
        out, "stock_symbol string, sentiment_score double, daily_change_percent double, "
        "news_count long, current_price double",
    )


def test_clusters(features):
    found = clusters.kmeans_symbols(features, restarts=5)
    frame = found.toPandas()
    assert len(frame) == 46
    true = frame["stock_symbol"].str[1]
    assert frame.groupby(true)["cluster"].nunique().eq(1).all()
    z = frame[[f"{c}_z" for c in clusters.CLUSTER_FEATURES]]
    assert np.allclose(z.mean(), 0) and np.allclose(z.std(ddof=0), 1)
    profile = clusters.cluster_profile(found).toPandas()
    assert sorted(profile["count"]) == [10, 11, 12, 13]
    assert rows(clusters.kmeans_symbols(features, restarts=5), "stock_symbol", "cluster") == rows(
        found, "stock_symbol", "cluster"
    )


def test_elbow(features):
    inertia = [r["inertia"] for r in clusters.kmeans_elbow(features, restarts=5).orderBy("k").collect()]
    assert len(inertia) == 6
    assert inertia[0] > inertia[1] > inertia[2]
    assert inertia[2] < 1e-2 * inertia[0]


def test_constant_feature_scales_to_zero(features):
    flat = clusters.scaled_cluster_features(features.withColumn("news_count", F.lit(5)))
    assert rows(flat.select("news_count_z").distinct()) == [(0.0,)]


def test_all_models_step_together_as_one_by_one(spark):
    """The joint steps end where plain Lloyd's steps from the same first centres end."""
    rng = np.random.default_rng(2)
    z = rng.normal(size=(300, 3)) + rng.integers(0, 3, (300, 1)) * 2
    frame = pd.DataFrame(z, columns=[f"{c}_z" for c in clusters.CLUSTER_FEATURES])
    frame["stock_symbol"] = [f"S{i}" for i in range(300)]
    points = spark.createDataFrame(frame)
    coded = points.withColumn("_code", F.xxhash64(F.lit(clusters.SEED), "stock_symbol", *clusters._Z))
    ks = [2, 3, 5]
    first = clusters._seeded(coded.repartition(5), np.repeat(ks, 4))
    assert np.array_equal(first, clusters._seeded(coded.coalesce(1), np.repeat(ks, 4)), equal_nan=True)
    best = {}
    for k, centres in zip(np.repeat(ks, 4), first):
        own = centres[:k]
        assert all((z == c).all(1).any() for c in own) and len(np.unique(own, axis=0)) == k
        for _ in range(300):
            near = ((z[:, None] - own) ** 2).sum(-1).argmin(1)
            own = np.array([z[near == i].mean(0) for i in range(k)])
        inertia = ((z - own[near]) ** 2).sum()
        best[k] = min(best.get(k, np.inf), inertia)
    fits = clusters.fit(points.repartition(3), ks, restarts=4, tolerance=0.0)
    assert fits.inertia == pytest.approx(best)
    members = clusters.assigned(points, fits.centres[3]).toPandas()
    assert sorted(members["cluster"].unique()) == [0, 1, 2]
    means = members.groupby("cluster")[clusters._Z].mean().to_numpy()
    assert np.allclose(means, fits.centres[3])


def test_more_clusters_than_points_and_no_points(spark, features):
    few = features.limit(3)
    assert clusters.kmeans_symbols(few, k=4, restarts=2).count() == 3
    assert clusters.kmeans_symbols(features.limit(0)).count() == 0
    assert clusters.kmeans_elbow(features.limit(0)).count() == 0
    same = features.withColumns({c: F.lit(1.0) for c in clusters.CLUSTER_FEATURES})
    assert rows(clusters.kmeans_symbols(same, restarts=2).select("cluster").distinct()) == [(0,)]


def test_equal_points_are_passed_over_as_one(spark, features, monkeypatch):
    """Copies of all symbols give the same centres, and as many rows to pass over."""
    written, write = [], clusters.materialize
    monkeypatch.setattr(clusters, "materialize", lambda df: written.append(write(df)) or written[-1])
    points = clusters.scaled_cluster_features(features)
    copies = points.withColumn("stock_symbol", F.explode(F.array([F.concat(F.lit(str(i)), "stock_symbol") for i in range(9)])))
    one, nine = clusters.fit(points, [4], 5), clusters.fit(copies, [4], 5)
    assert written[1].count() == written[0].count() and written[1].agg(F.sum("_n")).first()[0] == 46 * 9
    assert np.allclose(one.centres[4], nine.centres[4])
    assert nine.inertia[4] == pytest.approx(9 * one.inertia[4])
