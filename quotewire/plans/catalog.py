"""Registry of queries: each is an operator over the given tables, with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.functions.numbers import round_half_up
from quotewire.plans.inputs import Inputs


@dataclass(frozen=True)
class Query:
    build: Callable[[Inputs], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a builder ``Inputs -> DataFrame`` under ``name``."""

    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(build, sql)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Columns both engines print alike: doubles to 6 places, times and lists as text.

    Doubles are scaled before they are rounded, which is exact arithmetic in any engine.
    """

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = round_half_up(c * 1e6) / 1e6
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema.fields])


def rounded(body: str, *doubles: str) -> str:
    """SQL with the named columns rounded the way :func:`plain` does."""
    places = ", ".join(f'round("{c}" * 1e6) / 1e6 + 0.0 AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({places}) FROM ({body.strip()})"


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return plain(QUERIES[name].build(Inputs(spark, folder)))
