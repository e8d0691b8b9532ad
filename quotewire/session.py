"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # All dates are UTC days, whatever zone the cluster runs in.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partitions are merged up to this size. Daily rows take some 18 bytes each once compressed,
    # so the default of 64 MB leaves little more than a task per core, and cores wait.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Rows sent to Python hold whole pages and articles; the nodes of a page take many times
    # its size there, so a batch is bounded by bytes too, however many pages a task holds.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "2097152",
    # Split a hot key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The state of streams lies on disk, not in the heap, and may hold timers.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


#: Whole texts go to Python in batches of about 4 MB, not 64. A batch lies in the executor
#: and in its Python worker at once, each with room to grow, besides what is made of it.
TEXT_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def bound_text_batches(spark: SparkSession) -> dict[str, str]:
    """Send texts to Python in small batches from now on; returns the settings before."""
    before = {name: spark.conf.get(name) for name in TEXT_BATCHES}
    for name, value in TEXT_BATCHES.items():
        spark.conf.set(name, value)
    return before


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run within send texts to Python in small batches."""
    before = bound_text_batches(spark)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


#: Rows of a few numbers go to Python in batches bounded by their number alone. Below the
#: greatest limit of bytes Spark adds up the size of the batch again at every row, which
#: takes several times as long as all else that it does for such a row.
NUMBER_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2**31 - 1),
}


@contextmanager
def number_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run within send rows to Python in batches of so many rows, whatever their bytes:
    for rows of a few numbers only."""
    before = {name: spark.conf.get(name) for name in NUMBER_BATCHES}
    try:
        for name, value in NUMBER_BATCHES.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def build_session(
    app_name: str = "quotewire", master: str | None = None, **settings: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Where it is unset, a session with a local master gets a folder of its own, and any
    other session an error: executors would each write to a disk the others cannot see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="quotewire-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to a new table in the shared folder and read on from there.

    For inputs that several jobs re-read (model fits, multi-output workflows). Unlike a
    cache it survives the loss of executors, and later jobs read only the columns they
    need. The tables of an application stay until :func:`drop_materialized`.
    """
    path = f"{_own_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reread(df: DataFrame) -> DataFrame:
    """``df`` itself where it is no more than columns of parquet files, else :func:`materialize`.

    Such rows are as quick to read again as a copy of them, which would be written first.
    """
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        plain = kind in ("Project", "Filter") and node.deterministic() and node.subqueries().isEmpty()
        if not plain and not (kind == "LogicalRelation" and _is_parquet(node.relation())):
            return materialize(df)
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return df


def _is_parquet(relation) -> bool:
    return relation.getClass().getSimpleName() == "HadoopFsRelation" and relation.fileFormat().toString() == "Parquet"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/quotewire/{spark.sparkContext.applicationId}"


def drop_materialized(spark: SparkSession) -> None:
    """Delete all tables this application has written by :func:`materialize`.

    To be called once the results that read them have been written elsewhere.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
