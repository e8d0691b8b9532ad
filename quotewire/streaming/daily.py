"""Incremental counterparts of the crawl loop and of the daily counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

#: Parts of the delay within which rows of one key are cut to one before they meet.
SLICES = 16


def stream_ingest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "json",
    **options: str,
) -> DataFrame:
    """Stream of the rows in files as they land."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def event_time(stream: DataFrame, time: str) -> DataFrame:
    """Makes ``time`` a timestamp with zone, which watermarks need."""
    return stream.withColumn(time, F.col(time).cast("timestamp"))


class _FirstWithin(StatefulProcessor):
    """Lets a row of a key through unless one was let through fewer than SLICES slices away.

    The state of a key is the slice of the last row let through. A timer forgets it once
    the watermark says that no row can come that close any more.
    """

    def __init__(self, columns: list[str], width: int) -> None:
        self.columns, self.width = columns, width

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", T.StructType([T.StructField("slice", T.LongType())]))

    def _forgotten_at(self, kept: int) -> int:
        return (kept + SLICES + 1) * self.width

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(rows))
        fresh.columns = [*self.columns, "_slice", "_code"]  # Spark renames what is no identifier
        fresh = fresh.sort_values(["_slice", "_code"], kind="stable")
        known = int(self.kept.get()[0]) if self.kept.exists() else None
        last, through = known, []
        for i, at in enumerate(fresh["_slice"]):
            if last is None or abs(at - last) >= SLICES:
                through.append(i)
                last = int(at) if last is None else max(last, int(at))
        if last != known:
            if known is not None:
                self.handle.deleteTimer(self._forgotten_at(known))
            self.kept.update((last,))
            self.handle.registerTimer(self._forgotten_at(last))
        yield fresh.iloc[through].drop(columns=["_slice", "_code"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.kept.clear()
        return iter([])


def _cut(keys: Sequence[str]):
    """One row of each key and slice within each batch sent to Python."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.sort_values("_code", kind="stable").drop_duplicates([*keys, "_slice"])

    return run


def stream_dedup(
    stream: DataFrame, key: Sequence[str], time: str, delay: str = "1 day"
) -> DataFrame:
    """One arrival per key; repeats nearer than ``delay`` in time to it are dropped.

    A key that comes back ``delay`` after the row that came out comes out again, however
    many repeats were dropped between: they renew nothing. Times count in whole sixteenths
    of the delay, and of a key's rows in one of these one stands for all: the first by a
    hash of the row in the first micro-batch that has any. Rows later than the watermark
    and rows without a time are dropped. A null key is a key like any other.

    Each task cuts its rows to one per key and sixteenth before the shuffle, so a hot key
    brings few rows to any task. A key's state is one number, with a timer.
    """
    spark = stream.sparkSession
    millis = spark.sql(f"SELECT CAST(INTERVAL '{delay}' AS INTERVAL DAY TO SECOND)").first()[0]
    width = max(1, int(millis.total_seconds() * 1000) // SLICES)
    placed = event_time(stream, time).where(F.col(time).isNotNull())
    out = placed.schema
    placed = placed.withColumns({
        "_slice": F.floor(F.unix_millis(time) / width).cast("long"), "_code": F.xxhash64(*out.names)
    })
    return (
        placed.mapInPandas(_cut(key), placed.schema).withWatermark(time, delay).groupBy(*key)
        .transformWithStateInPandas(_FirstWithin(out.names, width), out, "append", "eventTime")
    )


def stream_daily_counts(
    stream: DataFrame,
    time: str,
    by: Sequence[str] = (),
    value: str | None = None,
    delay: str = "1 day",
) -> DataFrame:
    """Rows (and mean ``value``) per UTC day; a day is final once the watermark passes it.

    Rows that arrive later than that are dropped. In append mode days come out when they
    are final; :func:`upsert_available` keeps all days, open ones too, in a table.
    """
    day = F.window(time, "1 day")
    measures = [F.count("*").alias("count")]
    if value is not None:
        measures.append(F.avg(value).alias("mean"))
    counted = (
        event_time(stream, time).withWatermark(time, delay).groupBy(day.alias("_day"), *by)
        .agg(*measures)
    )
    return counted.select(
        F.date_format("_day.start", "yyyy-MM-dd").alias("date"),
        *[c for c in counted.columns if c != "_day"],
    )


def run_available(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Process all files there are, append to parquet at ``out`` and read it back."""
    query = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def upsert_available(stream: DataFrame, keys: Sequence[str], table: str, checkpoint: str) -> DataFrame:
    """Process all files there are and keep the last row of every key in ``table``.

    ``stream`` is an aggregation; each micro-batch writes the groups it changed to a folder
    of its own number, which a batch that is repeated after a failure replaces. So a rerun
    from the checkpoint counts nothing twice, and groups that are still open are there too.
    """

    def write(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{table}/batch={number}")

    query = (
        stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()
    return last_rows(stream.sparkSession, stream.schema, keys, table)


def last_rows(spark: SparkSession, schema: T.StructType, keys: Sequence[str], table: str) -> DataFrame:
    """The last row of every key in a table of :func:`upsert_available`."""
    changes = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
    rest = [f.name for f in schema.fields if f.name not in keys]
    # Numbers alone, so Spark aggregates them by hash and before the shuffle.
    return changes.parquet(table).groupBy(*keys).agg(
        *[F.max_by(c, "batch").alias(c) for c in rest]
    ).select(*schema.names)
