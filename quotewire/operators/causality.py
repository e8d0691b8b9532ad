"""Granger tests of all symbols at once, from sums of products alone.

A test of k lags compares two least-squares fits, and both need nothing of the rows but
the sums of products of their columns. One aggregation gives these sums for every symbol;
the fits are then eliminations in an array of a few dozen numbers per symbol.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Sizes below which a symbol is not tested, and the reported level.
GRANGER_MIN_ROWS = 50
GRANGER_MIN_COMPLETE = 20
GRANGER_MAX_LAG = 5
SIGNIFICANCE = 0.05

#: A column whose rest, after the columns before it, is this part of what it was depends
#: on them; a fit whose errors are this part of the target's spread is perfect.
DEPENDENT = 1e-10
_FRACTION_STEPS = 200
_SERIES_STEPS = 40


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0: a series below 1, a continued fraction above."""
    square = x * x
    term = lambda s, n: F.struct(
        (s["t"] * 2 * square / (2 * n + 1)).alias("t"), (s["sum"] + s["t"]).alias("sum")
    )
    steps = F.sequence(F.lit(1), F.lit(_SERIES_STEPS))
    series = F.aggregate(steps, F.struct(x.alias("t"), F.lit(0.0).alias("sum")), term, lambda s: s["sum"])
    below = 1 - 2 / math.sqrt(math.pi) * F.exp(-square) * series
    back = F.sequence(F.lit(_FRACTION_STEPS), F.lit(1))
    fraction = F.aggregate(back, F.lit(1.0), lambda f, n: 1 + n / (2 * square * f))
    above = F.exp(-square) / (x * math.sqrt(math.pi) * fraction)
    return F.when(x < 1, below).otherwise(above)


def chi2_tail(stat: Column, df: int) -> Column:
    """P(chi-square with ``df`` degrees of freedom > ``stat``)."""
    half = stat / 2
    total = F.exp(-half) if df % 2 == 0 else erfc(F.sqrt(half))
    term = F.exp(-half) if df % 2 == 0 else F.sqrt(half / math.pi) * 2 * F.exp(-half)
    for i in range(1, (df + 1) // 2):
        if df % 2 == 0:
            term = term * half / i
            total = total + term
        else:
            total = total + term
            term = term * half / (i + 0.5)
    return F.when(stat <= 0, 1.0).otherwise(total)


def _let(name: str, value: str, body: str) -> str:
    """``body`` with a name for ``value``, which is so worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _eliminated(matrix: str, size: int, pivots: int, least: str) -> str:
    """A square matrix of sums of products, as rows, after its last columns ``pivots`` are fitted.

    What is left at (i, j) is the sum of products of what the fit does not explain of i and
    of j; fitted rows are dropped. A column that the earlier ones explain changes nothing and
    is passed over.
    """
    for last in range(size - 1, size - 1 - pivots, -1):
        change = _let("e", f"get(r, {last})", "zip_with(r, p, (a, b) -> a - e * b / d)")
        step = f"if(d > {least}, transform(slice(m, 1, {last}), r -> {change}), slice(m, 1, {last}))"
        matrix = _let("m", matrix, _let("p", f"get(m, {last})", _let("d", f"get(p, {last})", step)))
    return matrix


def _products(series: DataFrame, cause: str, effect: str, max_lag: int, names: list[str]) -> DataFrame:
    """Per symbol: sample_size and ``parts``, up to max_lag + 1 structs (part, sums, low, high).

    Rows with p earlier ones count into part p, all from max_lag on into the last, so the
    rows that have k lags are those of the parts from k on. Both series are standardised
    first, which changes no statistic and keeps the sums exact.
    """
    # One order for all windows, so that the rows are put in order once.
    by_date = W.partitionBy("stock_symbol").orderBy("date")
    whole = by_date.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    both = F.lit(True)
    for c in ("x", "y"):
        both = both & F.col(c).isNotNull() & ~F.isnan(c)
    # The aggregates leave out rows without either value, as these are only dropped after them.
    told = series.select(
        "stock_symbol", "date", F.col(cause).cast("double").alias("x"), F.col(effect).cast("double").alias("y")
    ).select(
        "*", F.count("*").over(whole).alias("_days"), F.count_if(both).over(whole).alias("sample_size"),
        *[f(F.when(both, F.col(c))).over(whole).alias(f"_{n}_{c}")
          for c in "xy" for n, f in (("mean", F.avg), ("sd", F.stddev_pop))],
    ).where(both & (F.col("_days") >= GRANGER_MIN_ROWS) & (F.col("sample_size") >= GRANGER_MIN_COMPLETE))
    lagged = told.select(
        "*", F.least(F.row_number().over(by_date) - 1, F.lit(max_lag)).alias("_part"),
        *[F.lag(c, i).over(by_date).alias(f"_{c}_{i}") for c in "yx" for i in range(1, max_lag + 1)],
    )
    unit = lambda v, c: F.coalesce(F.try_divide(F.col(v) - F.col(f"_mean_{c}"), f"_sd_{c}"), F.lit(0.0))
    lagged = lagged.select(
        "stock_symbol", "sample_size", "_part", F.lit(1.0).alias("one"), unit("x", "x").alias("x_0"), unit("y", "y").alias("y_0"),
        # 0 where there is no such row yet, which no test of that lag reads
        *[unit(f"_{c}_{i}", c).alias(f"{c}_{i}") for c in "yx" for i in range(1, max_lag + 1)],
    )
    pairs = list(combinations_with_replacement(names, 2))
    lags = names[2:]
    listed = lambda items: ", ".join(items)
    # The rows of a part are known. Without their sum a row of five lags has the 100 columns
    # up to which Spark compiles an aggregation.
    sums = lagged.groupBy("stock_symbol", "sample_size", "_part").agg(
        *[F.expr(f"sum({a} * {b}) AS `{a}*{b}`") for a, b in pairs if (a, b) != ("one", "one")],
        *[F.expr(f"{f}({c}) AS {f}_{c}") for f in ("min", "max") for c in lags],
    )
    rows = f"if(_part < {max_lag}, 1D, sample_size - {max_lag})"
    part = F.expr(f"""named_struct('part', _part,
        'sums', array({listed(rows if (a, b) == ("one", "one") else f"`{a}*{b}`" for a, b in pairs)}),
        'low', array({listed(f"min_{c}" for c in lags)}), 'high', array({listed(f"max_{c}" for c in lags)}))""")
    return sums.groupBy("stock_symbol", "sample_size").agg(F.collect_list(part).alias("parts"))


def granger(
    series: DataFrame, cause: str = "sentiment_score", effect: str = "price_change_1d",
    max_lag: int = GRANGER_MAX_LAG,
) -> DataFrame:
    """Per symbol: sample_size, stat_k and lag_k for k lags, and the significant lags.

    ``lag_k`` is the p-value of "the past k values of ``cause`` help to predict
    ``effect``": the errors of ``effect`` on its own k lags against those after adding k
    lags of ``cause``; ``stat_k`` = n (restricted - full) / full is chi-square with k
    degrees of freedom. Rows without either value are left out first. Symbols with too few
    rows, a constant lag column or a perfect fit are left out.

    ``series`` has one row per symbol and day. Its windows and both groupings share one
    shuffle by symbol; after the first grouping a symbol is at most max_lag + 1 rows.
    """
    names = ["y_0", "one", *[f"{c}_{i}" for c in "yx" for i in range(1, max_lag + 1)]]
    spot = {p: i for i, p in enumerate(combinations_with_replacement(names, 2))}
    at = lambda a, b: spot[(a, b)] if (a, b) in spot else spot[(b, a)]
    table = _products(series, cause, effect, max_lag, names)
    ks = range(1, max_lag + 1)
    # Columns in the order opposite to that in which they are fitted.
    of_lag = {k: ["y_0", *[f"{c}_{i}" for c in "xy" for i in range(k, 0, -1)], "one"] for k in ks}

    def varies(k: int) -> str:
        own = ", ".join(str(names.index(name) - 2) for name in of_lag[k][1:-1])
        end = lambda f, n: f"array_{f}(transform(q, p -> get(p.{n}, i)))"
        varied = f"forall(array({own}), i -> {end('max', 'high')} > {end('min', 'low')})"
        return _let("q", f"filter(parts, p -> p.part >= {k})", varied)

    def statistic(k: int) -> str:
        """The statistic from the sums ``s`` of rows with k lags; NULL where the test is not defined."""
        size, least, n = 2 * k + 2, f"{DEPENDENT}D * sample_size", f"(sample_size - {k})"
        whole = ", ".join(f"array({', '.join(f'get(s, {at(a, b)})' for b in of_lag[k])})" for a in of_lag[k])
        spread = f"(get(s, {at('y_0', 'y_0')}) - pow(get(s, {at('y_0', 'one')}), 2) / {n})"
        first = "get(get(%s, 0), 0)"
        tested = _let("f", first % _eliminated("o", k + 1, k, least), _let(
            "v", first % "o", f"if(f > {DEPENDENT}D * {spread}, {n} * (v - f) / f, NULL)"
        ))
        return f"if({varies(k)}, {_let('o', _eliminated(f'array({whole})', size, k + 1, least), tested)}, NULL)"

    # The rows that have k lags are those that have one more and those of part k.
    of_part = lambda k: f"get(transform(filter(parts, p -> p.part = {k}), p -> p.sums), 0)"
    none = f"array_repeat(0D, {len(spot)})"
    statistics = "array()"
    for k in ks:
        more = "s" if k < max_lag else none
        sums = f"zip_with({more}, coalesce({of_part(k)}, {none}), (a, b) -> a + b)"
        statistics = _let("s", sums, f"concat({statistics}, array({statistic(k)}))")
    # Exploded, not filtered: a filter would have Spark work the statistics out twice.
    stats = F.array(F.expr(statistics))
    defined = F.filter(stats, lambda own: F.forall(own, lambda v: v.isNotNull()))
    table = table.select("stock_symbol", "sample_size", F.explode(defined).alias("stats"))
    table = table.withColumns({f"stat_{k}": F.get("stats", F.lit(k - 1)) for k in ks})
    table = table.withColumns({f"lag_{k}": chi2_tail(F.col(f"stat_{k}"), k) for k in ks})
    significant = F.array_compact(F.array(*[F.when(F.col(f"lag_{k}") < SIGNIFICANCE, f"lag_{k}") for k in ks]))
    return table.select(
        "stock_symbol", "sample_size", *[f"stat_{k}" for k in ks], *[f"lag_{k}" for k in ks],
        significant.alias("significant_lags"),
    )
