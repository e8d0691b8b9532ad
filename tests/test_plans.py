"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry
from quotewire.plans import registry

FOLDER = "/root/testdata/sf0.001"
# Fits models or drains a stream while it is built, so its plan is that of the result.
BUILDS_BY_JOBS = {"predict_direction", "predict_magnitude", "feature_importance", "research_workflow",
                  "kmeans_elbow", "predict_direction_told", "predict_magnitude_told",
                  "feature_importance_told", "kmeans_elbow_bands"}


def plan(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - BUILDS_BY_JOBS))
def test_no_pairwise_join_and_no_row_at_a_time_python(spark, name):
    text = plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in text


def test_group_limit_cuts_before_the_shuffle(spark):
    assert "Partial" in plan(spark, "limit_per_group").split("Exchange")[1]


def test_top_k_is_not_a_full_sort(spark):
    for name in ("top_sources", "top_movers", "ticker_mentions", "top_mentioned_stocks"):
        assert "TakeOrderedAndProject" in plan(spark, name)


def test_scans_read_only_what_is_needed(spark):
    text = plan(spark, "sentiment_vs_return")
    assert "o_custkey" not in text and "l_partkey" not in text


def test_dates_are_reduced_before_they_are_joined(spark):
    text = plan(spark, "join_by_date")
    assert text.index("Join") < text.index("HashAggregate")
    assert text.count("partial_avg") == 2


def test_workflows_read_each_input_once(spark, monkeypatch):
    """What is written on the way scans each input once; what is left scans none."""
    from quotewire.plans import workflows
    from quotewire.plans.inputs import Inputs

    written, write = [], workflows.materialize
    monkeypatch.setattr(workflows, "materialize", lambda df: written.append(df) or write(df))
    t = Inputs(spark, FOLDER)
    scans = lambda df, name: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [" + name)
    tables = workflows.full_workflow(t.news(), t.stock(), "S7")
    assert [(scans(df, "o_"), scans(df, "l_")) for df in written] == [(1, 0), (0, 1)]
    assert all(scans(df, "o_") == scans(df, "l_") == 0 for df in tables.values())
    written.clear()
    matched = write(t.matched())
    tables = workflows.matched_tables(matched)
    assert len(written) == 1
    sources = [name for name, df in tables.items() if "news_id" in df._jdf.queryExecution().analyzed().toString()]
    assert sources == ["volume_analysis"]


def test_a_run_is_summed_up_without_counting_again(spark):
    from quotewire.plans import workflows
    from quotewire.plans.inputs import Inputs

    t = Inputs(spark, FOLDER)
    tables = workflows.base_workflow(t.quotes(), t.posts())
    plan = tables["run_summary"]._jdf.queryExecution().optimizedPlan().toString()
    assert "s_suppkey" not in plan and "text" not in plan
    assert tables["run_summary"].first()["stocks_crawled"] == t.quotes().count()


def test_market_days_take_one_evaluation_of_the_series(spark):
    assert plan(spark, "market_daily").count("Scan parquet") == 1


def test_model_frame_takes_one_evaluation_of_the_series(spark):
    """Its size and its rows are both read from the written series."""
    text = plan(spark, "model_frame")
    assert "l_suppkey" not in text and text.count("SortAggregate") == 0


def written_series(spark, monkeypatch, name):
    """Plan of what a query writes as its series, and the plan of the rest."""
    from quotewire.plans import run_queries

    written, write = [], run_queries.materialize
    monkeypatch.setattr(run_queries, "materialize", lambda df: written.append(df) or write(df))
    rest = plan(spark, name)
    (series,) = written
    return series._jdf.queryExecution().executedPlan().toString(), rest


@pytest.mark.parametrize("name", ["model_frame", "scale_features", "train_test_split"])
def test_models_work_out_only_what_they_read_of_the_series(spark, monkeypatch, name):
    """No mean change (l_tax), no volume, one state of the last price, each time parsed once."""
    text, _ = written_series(spark, monkeypatch, name)
    assert "l_tax" not in text and "volume" not in text
    assert text.count("partial_max(") == 1 and text.count("partial_avg(") == 1
    assert text.count("try_cast") == 1


@pytest.mark.parametrize("name", ["scale_features", "train_test_split"])
def test_the_side_of_the_split_is_worked_out_once(spark, monkeypatch, name):
    text, rest = written_series(spark, monkeypatch, name)
    assert text.count("md5(") == 1 and "md5(" not in rest


def test_partitions_are_merged_to_a_size_that_keeps_all_cores_busy(spark):
    from quotewire.plans.inputs import Inputs

    assert Inputs(spark, FOLDER).spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_research_copies_neither_parquet_columns_nor_its_series(spark, monkeypatch):
    """Written are the series with its split and small tables; of other pairs, what is read of them."""
    from quotewire.operators import models
    from quotewire.plans import workflows
    from quotewire.plans.inputs import Inputs
    from quotewire.session import reread

    written, write = [], workflows.materialize
    keep = lambda df: written.append(df.columns) or write(df)
    monkeypatch.setattr(workflows, "materialize", keep)
    monkeypatch.setattr(models, "materialize", keep)
    pairs = Inputs(spark, FOLDER).pairs("S")
    found = workflows.research_workflow(pairs, trees=4)
    series = found.tables["time_series"].columns
    assert written[0] == [*series, "_train"] and "volume" in series and "price_change_5d" in series
    assert written[1] == ["_train", "code", "y", "n"] and len(written) == 4
    assert reread(pairs) is pairs
    for other in (pairs.distinct(), pairs.limit(3), pairs.mapInArrow(lambda b: b, pairs.schema)):
        again = reread(other)
        assert again is not other and again.dtypes == other.dtypes
    mentioned = workflows.research_workflow(pairs.distinct(), trees=4).tables["top_mentioned_stocks"]
    assert mentioned.collect() == found.tables["top_mentioned_stocks"].collect()
