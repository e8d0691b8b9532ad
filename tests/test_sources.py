import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from quotewire import schemas
from quotewire.operators import summaries
from quotewire.plans import workflows
from quotewire.plans.inputs import NEGATIVE, POSITIVE, SITE, Inputs
from quotewire.operators.pages import build_chunks
from quotewire.sources import readers, writers
from quotewire.streaming import daily as streams

ROW = schemas.struct_of(post_id=T.StringType(), symbol=T.StringType(), change_percent=T.DoubleType())


def test_snapshots_of_every_kind(spark, tmp_path):
    files = {
        "a.json": {"posts": [{"post_id": "1"}, {"post_id": "2"}], "chunks": [{"post_id": "3"}], "more": 1},
        "b.json": [{"symbol": "A", "change_percent": 1.5}, {"symbol": "B", "other": "x"}],
        "c.json": {"total": 2, "top_gainers": [{"symbol": "C"}], "top_losers": [{"symbol": "D"}]},
        "d.json": {"post_id": "9", "symbol": "é"},
        "empty.json": {"posts": [], "chunks": []},
        "other.txt": [{"post_id": "no"}],
    }
    for name, content in files.items():
        (tmp_path / name).write_text(json.dumps(content, indent=2, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "bad.json").write_text('{"posts": [')
    got, rejects = readers.read_snapshots(spark, str(tmp_path), ROW)
    assert rows(got, "post_id", "symbol", "change_percent") == sorted([
        ("1", None, None), ("2", None, None), ("3", None, None), (None, "A", 1.5), (None, "B", None),
        (None, "C", None), (None, "D", None), ("9", "é", None),
    ], key=repr)
    bad = rejects.collect()
    assert [r["file"].rsplit("/", 1)[1] for r in bad] == ["bad.json"]


def test_stock_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("code,day,o,h,l,c,v\nA,2024-01-01,1,2,0.5,1.5,10\n")
    (tmp_path / "y.csv").write_text("code,day,o,h,l,c,v\nB,2024-01-02,1,2,bad,1.5,10\n")
    good = readers.read_stock_csv(spark, f"{tmp_path}/x.csv")
    assert good.schema == schemas.STOCK
    assert rows(good) == [("A", "2024-01-01", 1.0, 2.0, 0.5, 1.5, 10)]
    with pytest.raises(Exception, match="bad|MALFORMED|FAILFAST"):
        readers.read_stock_csv(spark, f"{tmp_path}/*.csv").collect()
    both = readers.read_stock_csv(spark, f"{tmp_path}/*.csv", mode="PERMISSIVE")
    assert rows(both, "stockCode", "low") == [("A", 0.5), ("B", None)]


def test_missing_document_is_empty(spark, tmp_path):
    df = readers.read_json_doc(spark, f"{tmp_path}/none", ROW)
    assert df.schema == ROW and df.count() == 0


def test_json_keeps_text_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([("é—\U0001f600", None)], "a string, b string").coalesce(1)
    writers.write_json(df, f"{tmp_path}/j")
    (part,) = [p for p in (tmp_path / "j").iterdir() if p.name.startswith("part")]
    assert json.loads(part.read_text(encoding="utf-8")) == {"a": "é—\U0001f600", "b": None}
    writers.write_json(df.limit(0), f"{tmp_path}/j")  # replaces what was there
    assert readers.read_json_doc(spark, f"{tmp_path}/j", df.schema, multi_line=False).count() == 0


def test_documents_grow_in_number_not_in_size(spark, tmp_path):
    from quotewire.plans import run_queries

    n = 30_000
    spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("s").alias("source"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
    ).write.parquet(f"{tmp_path}/documents.parquet")
    got = run_queries.read_json_doc(Inputs(spark, str(tmp_path)))
    sizes = [r["n"] for r in got.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) <= run_queries.DOCUMENT_POSTS
    assert sum(sizes) == got.select("post_id").distinct().count() == n


def test_indented_documents(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"a": "x", "b": 1}, indent=2))
    (tmp_path / "two.json").write_text(json.dumps([{"a": "y", "b": 2}, {"a": "z"}], indent=4))
    df = readers.read_json_doc(spark, str(tmp_path), spark.createDataFrame([], "a string, b int").schema)
    assert rows(df) == [("x", 1), ("y", 2), ("z", None)]
    (tmp_path / "bad.json").write_text('{"a": "x", ')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        readers.read_json_doc(spark, str(tmp_path), df.schema).collect()


def test_read_news_from_json(spark, tmp_path):
    (tmp_path / "n.json").write_text(
        '{"_id": 7, "publishTime": "2024-01-01T10:00:00Z", "source": "s", "sentimentScore": "0.5"}\n'
    )
    df = readers.read_news(spark, f"{tmp_path}/n.json", format="json")
    assert [f.dataType for f in df.schema.fields] == [
        T.StringType(), T.TimestampType(), T.StringType(), T.DoubleType()
    ]
    assert df.select("newsId", F.unix_seconds("newsTime"), "sentiment").first() == ("7", 1704103200, 0.5)


def test_result_tables_skip_empty_and_flatten(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"])], "k string, v array<string>")
    assert writers.write_result_tables({"full": df, "none": df.limit(0)}, str(tmp_path)) == ["full"]
    assert not (tmp_path / "none").exists()
    assert rows(spark.read.csv(f"{tmp_path}/full", header=True, escape='"')) == [("a", '["x","y"]')]


def test_bundles(spark, tmp_path, capsys):
    t = Inputs(spark, "/root/testdata/sf0.001")
    posts = t.posts()
    writers.write_news(posts, build_chunks(posts, SITE), f"{tmp_path}/n")
    writers.write_stocks(t.part_quotes(), f"{tmp_path}/s")
    tables = workflows.base_workflow(t.quotes(), posts)
    writers.write_sentiment(tables["scored"], f"{tmp_path}/m")
    writers.write_analysis(tables["pairs"], workflows.correlation_sections(tables["pairs"]), f"{tmp_path}/a")
    written = {str(p.parent.relative_to(tmp_path)) for p in tmp_path.rglob("_SUCCESS")}
    assert {"n/posts", "n/chunks", "n/news_summary", "s/stocks_csv", "s/top_movers", "m/scored",
            "m/sentiment_summary", "a/integrated", "a/correlations/overall_correlation"} <= written
    assert spark.read.json(f"{tmp_path}/m/extreme_articles").count() == 2
    writers.show_df(summaries.stock_summary(t.quotes()), "Quotes")
    assert "=== Quotes ===" in capsys.readouterr().out


def test_skip_sentiment(spark):
    t = Inputs(spark, "/root/testdata/sf0.001")
    tables = workflows.base_workflow(t.quotes(), t.posts(), skip_sentiment=True)
    assert tables["run_summary"].first()["sentiment_analysis_skipped"] is True
    assert tables["run_summary"].first()["articles_with_sentiment"] == 0
    assert rows(tables["pairs"].select("news_sentiment", "sentiment_score").distinct()) == [("neutral", 0.0)]
    assert "sentiment_summary" not in tables
    scored = workflows.base_workflow(t.quotes(), t.posts())
    assert scored["daily_digest"].count() == 1


def test_no_articles_gives_an_empty_report(spark):
    t = Inputs(spark, "/root/testdata/sf0.001")
    tables = workflows.correlation_report(
        t.posts().limit(0), t.quotes(), ["name"],
        {"positive": POSITIVE, "negative": NEGATIVE},
    )
    assert tables["matched"].count() == 0
    assert tables["totals"].first()["total_matches"] == 0


# --- streams --------------------------------------------------------------------------------

EVENT = schemas.struct_of(id=T.LongType(), symbol=T.StringType(), ts=T.StringType(), value=T.DoubleType())


def land(folder, name, *events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(
        json.dumps(dict(zip(("id", "symbol", "ts", "value"), e))) for e in events
    ))


def test_daily_counts_over_several_runs(spark, tmp_path):
    inbox, out, progress = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/progress"

    def run():
        stream = streams.stream_ingest(spark, str(inbox), EVENT)
        counts = streams.stream_daily_counts(stream, "ts", ["symbol"], "value")
        return rows(streams.run_available(counts, out, progress), "date", "symbol", "count", "mean")

    land(inbox, "1.json", (1, "A", "2024-01-01T01:00:00Z", 1.0), (2, "A", "2024-01-02T23:00:00Z", 5.0))
    assert run() == []
    # the watermark of the first run is 2024-01-01 23:00: the first day is still open
    land(inbox, "2.json", (3, "A", "2024-01-01T23:30:00Z", 3.0), (4, "B", "2024-01-04T01:00:00Z", 1.0))
    assert run() == [("2024-01-01", "A", 2, 2.0), ("2024-01-02", "A", 1, 5.0)]
    # now the first day is closed: a late row changes nothing
    land(inbox, "3.json", (5, "A", "2024-01-01T12:00:00Z", 9.0), (6, "B", "2024-01-06T00:30:00Z", 1.0))
    assert run() == [
        ("2024-01-01", "A", 2, 2.0), ("2024-01-02", "A", 1, 5.0), ("2024-01-04", "B", 1, 1.0)
    ]


def test_daily_counts_keep_open_days_and_count_nothing_twice(spark, tmp_path):
    inbox, table, progress = tmp_path / "in", f"{tmp_path}/table", f"{tmp_path}/progress"

    def run(checkpoint=progress):
        stream = streams.stream_ingest(spark, str(inbox), EVENT)
        counts = streams.stream_daily_counts(stream, "ts", ["symbol"], "value")
        return rows(streams.upsert_available(counts, ["date", "symbol"], table, checkpoint))

    land(inbox, "1.json", (1, "A", "2024-01-01T01:00:00Z", 1.0), (2, None, "2024-01-02T23:00:00Z", 5.0))
    first = [("2024-01-01", "A", 1, 1.0), ("2024-01-02", None, 1, 5.0)]
    assert run() == first
    assert run() == first  # nothing new
    land(inbox, "2.json", (3, "A", "2024-01-01T23:30:00Z", 3.0), (4, "A", "2024-01-04T01:00:00Z", 2.0))
    second = [("2024-01-01", "A", 2, 2.0), ("2024-01-02", None, 1, 5.0), ("2024-01-04", "A", 1, 2.0)]
    assert run() == second
    # A batch that wrote its rows but was not recorded as done runs again and replaces them.
    import os

    last = max(int(n) for n in os.listdir(f"{progress}/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{progress}/commits/{name}"):
            os.remove(f"{progress}/commits/{name}")
    assert run() == second
    land(inbox, "3.json", (5, "A", "2024-01-01T12:00:00Z", 9.0))  # the day is closed
    assert run() == second


def test_stream_dedup(spark, tmp_path):
    inbox = tmp_path / "in"

    def run():
        stream = streams.stream_ingest(spark, str(inbox), EVENT)
        kept = streams.stream_dedup(stream, ["symbol"], "ts")
        return rows(streams.run_available(kept, f"{tmp_path}/out", f"{tmp_path}/progress"), "symbol", "id")

    land(inbox, "1.json", (1, "A", "2024-01-01T00:00:00Z", 1.0), (9, "B", None, 1.0))
    assert run() == [("A", 1)]  # no time, no place
    land(inbox, "2.json", (2, "A", "2024-01-01T09:00:00Z", 1.0), (3, "B", "2024-01-01T09:00:00Z", 1.0),
         (6, None, "2024-01-01T09:00:00Z", 1.0), (7, None, "2024-01-01T10:00:00Z", 1.0))
    got = run()
    assert [r for r in got if r[0]] == [("A", 1), ("B", 3)] and len(got) == 3
    # A day after the row that came out, though a dropped repeat lies between.
    land(inbox, "3.json", (5, "A", "2024-01-02T00:30:00Z", 1.0), (8, "B", "2024-01-02T08:00:00Z", 1.0))
    assert [r for r in run() if r[0]] == [("A", 1), ("A", 5), ("B", 3)]
    land(inbox, "4.json", (4, "C", "2024-01-09T00:00:00Z", 1.0))
    run()
    land(inbox, "5.json", (10, "B", "2024-01-09T01:00:00Z", 1.0))
    assert sorted(r for r in run() if r[0] and r[0] != "A") == [("B", 3), ("B", 10), ("C", 4)]


def test_stream_dedup_of_a_hot_key_over_many_batches(spark, tmp_path):
    inbox = tmp_path / "in"
    for hour in range(0, 60, 12):
        land(inbox, f"{hour}.json", *[
            (hour * 1000 + i, "H", f"2024-01-0{1 + hour // 24}T{hour % 24:02d}:{i % 60:02d}:00Z", 1.0) for i in range(600)
        ])
    stream = streams.stream_ingest(spark, str(inbox), EVENT, maxFilesPerTrigger="1").withColumnRenamed("value", "a b")
    kept = streams.stream_dedup(stream, ["symbol"], "ts")
    got = streams.run_available(kept, f"{tmp_path}/out", f"{tmp_path}/progress")
    assert got.columns == ["id", "symbol", "ts", "a b"]
    # One row each at hours 0, 24 and 48, of the 3,000.
    assert [r["id"] // 1000 for r in got.orderBy("ts").collect()] == [0, 24, 48]


def test_the_cut_leaves_one_row_of_a_key_and_slice():
    import pandas as pd

    frame = pd.DataFrame({"k": ["a"] * 500 + ["b", None, None], "_slice": [1, 2] * 250 + [1, 1, 1], "_code": range(503)})
    (cut,) = streams._cut(["k"])(iter([frame]))
    assert sorted(cut["_code"]) == [0, 1, 500, 501]


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from quotewire.session import shared_folder

    def session(master, folder=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf={"spark.checkpoint.dir": folder}, sparkContext=context)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("local-cluster[3,2,1024]"))
    assert shared_folder(session("yarn", "hdfs:///scratch")) == "hdfs:///scratch"


def test_materialized_tables_can_be_dropped(spark):
    from quotewire.session import drop_materialized, materialize

    df = materialize(spark.range(5))
    assert df.count() == 5
    other = spark.newSession()
    drop_materialized(spark)
    drop_materialized(other)  # nothing left is fine
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FileNotFound"):
        df.collect()
    assert materialize(spark.range(3)).count() == 3
