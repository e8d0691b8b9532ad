"""Readers for news collections, price files and crawl snapshots."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.schemas import STOCK

# Fields of a news document, as expressions over the collection.
NEWS_FIELDS = {
    "newsId": "_id",
    "newsTime": "publishTime",
    "newsSource": "source",
    "sentiment": "sentimentScore",
}
_NEWS_TYPES = {"newsId": "string", "newsTime": "timestamp", "sentiment": "double"}

# Fields of a snapshot object that hold its rows.
ROW_HOLDERS = ("posts", "chunks", "top_gainers", "top_losers")
_CORRUPT = "_corrupt_record"


def read_news(
    spark: SparkSession,
    path: str | None = None,
    format: str = "parquet",
    fields: Mapping[str, str] = NEWS_FIELDS,
    **options: str,
) -> DataFrame:
    """News rows from any source format, with its options passed through.

    A document store works the same way where its connector is on the class path:
    ``read_news(spark, format="mongodb", collection="news_collection")``.
    """
    raw = spark.read.format(format).options(**options).load(path)
    return raw.select(*[
        (F.expr(e).cast(_NEWS_TYPES[name]) if name in _NEWS_TYPES else F.expr(e)).alias(name)
        for name, e in fields.items()
    ])


def read_stock_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Price rows from headered CSV files (a path or glob), columns by position.

    A bad number fails the read; ``mode="PERMISSIVE"`` makes it NULL instead.
    """
    return spark.read.schema(STOCK).option("header", True).option("mode", mode).csv(path)


def read_snapshots(
    spark: SparkSession,
    path: str,
    row: T.StructType,
    pattern: str = "*.json",
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Rows of every JSON snapshot in a folder, and the files that could not be read.

    A list holds rows. An object that has ``posts``, ``chunks``, ``top_gainers`` or
    ``top_losers`` holds the rows of these; any other object is one row. Rows have the
    columns of ``row``, NULL where a snapshot lacks them. Rejects: file, content.
    Without ``multi_line`` every line of a file is a snapshot.
    """
    holders = [T.StructField(h, T.ArrayType(row)) for h in ROW_HOLDERS]
    schema = T.StructType([*row.fields, *holders, T.StructField(_CORRUPT, T.StringType())])
    raw = (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("pathGlobFilter", pattern)
        .json(path)
    )
    # NULL, not [], where an object holds no rows by name; concat needs the type
    held = [F.coalesce(h, F.array().cast(T.ArrayType(row))) for h in ROW_HOLDERS]
    is_row = F.coalesce(*ROW_HOLDERS).isNull()
    own = F.array(F.struct(*row.names).cast(row))
    rows = (
        raw.where(F.col(_CORRUPT).isNull())
        .select(F.explode(F.when(is_row, own).otherwise(F.concat(*held))).alias("_row"))
        .select("_row.*")
    )
    # Spark reads no file for the corrupt column alone, so another column goes with it
    content = F.coalesce(_CORRUPT, F.col(row.names[0]).cast("string"))
    rejects = raw.where(F.col(_CORRUPT).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), content.alias("content")
    )
    return rows, rejects


def read_json_doc(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """Rows of JSON documents; none where the path is missing.

    A file holds one document, laid out over as many lines as it likes: an object is a
    row, a list holds rows. Files of JSON lines, as :func:`writers.write_json` makes them,
    are read with ``multi_line=False``. What cannot be read is an error.
    """
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST")
    try:
        return reader.json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
