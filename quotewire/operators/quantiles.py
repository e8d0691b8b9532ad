"""Exact quantiles that never hold a group in one task.

Spark's ``percentile`` keeps all distinct values of a group in one buffer. Here equal
values are counted first, each group is cut into cells of equal width in the logarithm of
the value, and only the cells in which a wanted rank falls are cut again, until each holds
few enough values to be put in order in one place. Cells follow the logarithm because
prices, volumes and market values spread over many powers of ten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewire.operators.keyed import lookup_join, not_null
from quotewire.session import materialize

CELLS = 4096
#: Values of a cell that are put in order in one task; larger cells are cut again.
ORDERED = 4096
QUARTILES = (0.25, 0.5, 0.75)


def _scale(v: Column) -> Column:
    """Rises with v, as its logarithm does on either side of zero (doubles end at e**-745)."""
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.ln(F.abs(v)) + 746))


def _cell(cells: int) -> Column:
    """By the logarithm; by the value itself once its ends have equal logarithms."""
    low, high, v = (_scale(F.col(c)) for c in ("_low", "_high", "_v"))
    place = F.coalesce(
        F.try_divide(v - low, high - low),
        F.try_divide(F.col("_v") - F.col("_low"), F.col("_high") - F.col("_low")),
    )
    return F.least(F.lit(cells - 1), F.floor(F.coalesce(place, F.lit(0.0)) * cells).cast("int"))


def _wanted(probabilities: Sequence[float]) -> Column:
    """The two neighbouring ranks of each probability, with their weights."""
    out = []
    for p in probabilities:
        place = (F.col("_total") - 1) * F.lit(float(p))
        low = F.floor(place)
        for rank, weight in ((low, 1 - (place - low)), (low + 1, place - low)):
            out.append(F.struct(
                F.lit(float(p)).alias("probability"), rank.alias("rank"), weight.alias("weight")
            ))
    return F.filter(F.array(*out), lambda w: w["weight"] > 0)


def _hits(first: Column, count: Column) -> Column:
    """The wanted ranks among ``count`` rows of which ``first`` is the lowest rank."""
    return F.filter("_wanted", lambda w: (w["rank"] >= first) & (w["rank"] < first + count))


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float] = QUARTILES,
    by: Sequence[str] = (),
    cells: int = CELLS,
    ordered: int = ORDERED,
) -> DataFrame:
    """Rows (by..., probability, quantile), linear between neighbouring values.

    NULL values are ignored; a group without values has no rows. The input is read once;
    counted values and, from then on, the cells still in question are written out.
    """
    return _quantiles(counted(df, value, by), probabilities, by, cells, ordered)


def counted(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Rows (by..., _v, _n): how often each value occurs, in a written table."""
    return materialize(
        df.where(not_null(value, *by))
        .groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    )


def _quantiles(
    values: DataFrame, probabilities: Sequence[float], by: Sequence[str], cells: int, ordered: int
) -> DataFrame:
    slots = [*by, "_slot"]
    values = values.withColumn("_slot", F.lit(0).cast("long"))

    def attach(rows: DataFrame, ranges: DataFrame, columns: list[str], whole: bool) -> DataFrame:
        if whole:  # one range, for every row
            only = ranges.select(F.struct(*columns)).scalar()
            return rows.withColumn("_r", only).select(*rows.columns, "_r.*")
        info = ranges.select(*slots, *columns)
        if not by:  # at most two ranges per probability
            return rows.join(F.broadcast(info), slots)
        return lookup_join(rows, info, slots)

    ranges = values.groupBy(*slots).agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.sum("_n").alias("_total")
    ).select(
        *slots, "_low", "_high", F.lit(0).cast("long").alias("_before"),
        _wanted(probabilities).alias("_wanted"),
    )
    whole = not by
    while values.groupBy(*slots).agg(F.count("*").alias("_n")).where(F.col("_n") > ordered).limit(1).count():
        celled = attach(values, ranges, ["_low", "_high"], whole).withColumn("_cell", _cell(cells))
        parts = celled.groupBy(*slots, "_cell").agg(
            F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.sum("_n").alias("_n")
        )
        # at most `cells` rows per slot
        earlier = W.partitionBy(*slots).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
        first = F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
        inner = F.xxhash64("_slot", "_cell").alias("_slot")
        ranges = materialize(
            attach(parts, ranges, ["_before", "_wanted"], whole)
            .withColumn("_before", first)
            .withColumn("_wanted", _hits(F.col("_before"), F.col("_n")))
            .where(F.size("_wanted") > 0)
            .select(*by, inner, "_low", "_high", "_before", "_wanted")
        )
        values = materialize(
            attach(celled.select(*by, inner, "_v", "_n"), ranges, [], False)
        )
        whole = False

    earlier = W.partitionBy(*slots).orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    first = F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    return (
        attach(values, ranges, ["_before", "_wanted"], whole)
        .withColumn("_first", first)
        .select(*by, "_v", F.explode(_hits(F.col("_first"), F.col("_n"))).alias("_w"))
        .groupBy(*by, F.col("_w.probability").alias("probability"))
        .agg(F.sum(F.col("_w.weight") * F.col("_v")).alias("quantile"))
    )


def box(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Box-plot row (per group): n, minimum, q1, median, q3, maximum."""
    values = counted(df, value, by)
    q = _quantiles(values, QUARTILES, by, CELLS, ORDERED)
    quartiles = q.groupBy(*by).agg(*[
        F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
        for p, name in zip(QUARTILES, ("q1", "median", "q3"))
    ])
    ends = values.groupBy(*by).agg(
        F.sum("_n").alias("n"), F.min("_v").alias("minimum"), F.max("_v").alias("maximum")
    )
    names = ["n", "minimum", "q1", "median", "q3", "maximum"]
    if by:
        return ends.join(quartiles, list(by)).select(*by, *names)
    found = quartiles.select(F.struct("*")).scalar()
    return ends.withColumn("_q", found).select(
        "n", "minimum", "_q.q1", "_q.median", "_q.q3", "maximum"
    )
