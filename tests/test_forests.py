import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from quotewire.operators import forests, summaries
from quotewire.session import NUMBER_BATCHES

FEATURES = ("a", "b", "c")


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(4)
    x = pd.DataFrame({"a": rng.normal(size=400), "b": rng.integers(0, 5, 400).astype(float), "c": rng.normal(size=400)})
    x["y"] = np.where(x["a"] > 0.3, 2.0, 0.0) + x["b"] * 0.5 + rng.normal(size=400) * 0.1
    return spark.createDataFrame(x)


def same(m, n):
    return all(np.allclose(p, q, rtol=1e-9, atol=1e-12) for p, q in zip(m.trees.arrays(), n.trees.arrays()))


def test_equal_rows_are_counted_before_any_pass(frame):
    """Sixty copies of the rows are passed over as one, and a pass costs what it did."""
    edges = forests.bin_edges(frame, FEATURES)
    once = forests._counted(frame, FEATURES, "y", edges)
    copies = frame.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("_")
    sixty = forests._counted(copies, FEATURES, "y", edges)
    assert sixty.count() == once.count() and {r["n"] for r in sixty.collect()} == {60 * r["n"] for r in once.collect()}
    more = forests._counted(copies.union(copies), FEATURES, "y", edges)
    assert more.agg(F.sum("n")).first()[0] == 400 * 120 and more.agg(F.max("n")).first()[0] == forests.MOST_EQUAL


def test_draws_follow_the_poisson_law():
    table = forests._draws().reshape(-1, 1 << 16).astype(float)
    for n in (1, 2, 17, forests.MOST_EQUAL):
        assert table[n].mean() == pytest.approx(n, rel=1e-3) and table[n].var() == pytest.approx(n, rel=5e-3)
    assert (table[1] == 0).mean() == pytest.approx(np.exp(-1), abs=1e-4)


def test_trees_do_not_depend_on_where_the_rows_lie(frame):
    one = forests.fit(frame.coalesce(1), FEATURES, "y", 6, 4, 3, tried=2)
    assert same(one, forests.fit(frame.repartition(7), FEATURES, "y", 6, 4, 3, tried=2))
    assert len(one.trees.left) > 6 * 7


def test_splits_are_the_best_ones_of_the_drawn_rows(frame, monkeypatch):
    model = forests.fit(frame, FEATURES, "y", 5, 3, 42)
    monkeypatch.setattr(forests, "OPEN_NODES", 3)  # and in several turns
    assert same(model, forests.fit(frame, FEATURES, "y", 5, 3, 42))
    cells = forests._counted(frame, FEATURES, "y", model.edges).toPandas()
    code, y = cells["code"].to_numpy(), cells["y"].to_numpy()
    bins = np.stack([code >> 5 * (2 - i) & 31 for i in range(3)])
    table = forests._draws().reshape(-1, 1 << 16)
    seen, gains = 0, np.zeros((5, 3))
    for tree in range(5):
        bits = forests._mix(cells["key"].to_numpy().view(np.uint64) + np.uint64((42 * 1_000_003 + tree // 4 + 1) * 0x9E3779B97F4A7C15 % 2**64))
        w = table[cells["n"], (bits >> np.uint64(tree % 4 * 16) & np.uint64(0xFFFF)).astype(int)].astype(float)

        def error(some):
            return ((y[some] - np.average(y[some], weights=w[some])) ** 2 * w[some]).sum() if w[some].sum() else np.inf

        stack = [(tree, w > 0, 0)]
        while stack:
            node, some, depth = stack.pop()
            t = model.trees
            assert t.value[node] == pytest.approx(np.average(y[some], weights=w[some]))
            if t.left[node] == node:
                assert depth == 3 or some.sum() < 3 or error(some) < 1e-9
                continue
            tried = {(f, b): error(some) - error(some & (bins[f] <= b)) - error(some & (bins[f] > b)) for f in range(3) for b in range(31)}
            best = tried[t.feature[node], t.edge[node]]
            assert best == pytest.approx(max(tried.values()))
            gains[tree, t.feature[node]] += best
            seen += 1
            left = some & (bins[t.feature[node]] <= t.edge[node])
            stack += [(t.left[node], left, depth + 1), (t.left[node] + 1, some & ~left, depth + 1)]
    assert seen > 20
    share = (gains / gains.sum(1, keepdims=True)).mean(0)
    assert model.importances == pytest.approx(share)


def test_last_of_two_columns_where_either_is_missing(spark):
    df = spark.createDataFrame(
        [("A", 1, 1.0, "x"), ("A", 2, None, "y"), ("A", 3, 3.0, None), ("B", 1, None, "z"), ("B", 2, None, None),
         ("C", 1, 1.0, None), ("C", 2, 2.0, "q"), ("D", 1, None, None), ("E", 1, 5.0, None), ("E", 2, None, "w")],
        "k string, o int, a double, b string",
    )
    got = df.groupBy("k").agg(*summaries.ordered_last_two("a", "b", ["o"]))
    apart = df.groupBy("k").agg(*[summaries.ordered_last(c, ["o"]).alias(c) for c in ("a", "b")])
    assert rows(got) == rows(apart)


def test_rows_of_numbers_reach_python_in_batches_bounded_by_their_number(spark, frame, monkeypatch):
    """A limit of bytes has Spark add up the size of a batch at every row; it is back afterwards."""
    names, write, seen = list(NUMBER_BATCHES), forests.materialize, []
    before = [spark.conf.get(n) for n in names]
    monkeypatch.setattr(forests, "materialize", lambda df: seen.append([spark.conf.get(n) for n in names]) or write(df))
    forests.fit(frame, FEATURES, "y", 2, 2, 3)
    assert seen == [list(NUMBER_BATCHES.values())] != [before]
    assert [spark.conf.get(n) for n in names] == before


def test_counted_rows_of_either_side_are_scored_as_the_rows_are(frame):
    edges = forests.bin_edges(frame, FEATURES)
    split = frame.unionAll(frame).withColumn("_train", F.col("b") < 3)
    equal = forests.counted_equal(split, FEATURES, "y", edges, "_train")
    assert equal.agg(F.sum("n")).first()[0] == 800 and equal.agg(F.min("n")).first()[0] >= 2
    own, train = equal.where("_train").drop("_train"), split.where("_train")
    model = forests.fit_counted(own, edges, FEATURES, 6, 4, 3)
    assert np.isclose(model.trees.value[:6].mean(), train.agg(F.avg("y")).first()[0], atol=0.2)
    told = model.transform_counted(own, "p").agg(F.sum(F.col("n") * F.col("p"))).first()[0]
    assert told == pytest.approx(model.transform(train, "p").agg(F.sum("p")).first()[0])
