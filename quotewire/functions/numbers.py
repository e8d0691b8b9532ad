"""Numbers written as text, and rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotewire.functions.text import strip

# Guards the cast: Spark alone would read '1d' as 1.0.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _as_number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def safe_float(text: Column, default: float = 0.0, extended: bool = False) -> Column:
    """Number in ``text`` without ',', '$', one trailing '%' or leading '+'.

    A percentage is not divided by 100. Anything else ('N/A', '--', '', NULL, ...)
    gives ``default``. ``extended`` also drops inner spaces.
    """
    bare = strip(F.regexp_replace(text, "[,$ ]" if extended else "[,$]", ""))
    bare = F.regexp_replace(bare, "%$", "")
    if not extended:
        bare = F.regexp_replace(bare, r"^\+", "")
    return F.coalesce(_as_number(strip(bare)), F.lit(float(default)))


def round_half_up(number: Column) -> Column:
    """Nearest whole double, halves away from zero: ``F.round`` of a double without the decimal
    number that it makes of each value. The difference to the nearest is exact."""
    near = F.rint(number)
    half = F.abs(number - near) == 0.5
    return F.when(half, number + F.signum(number) * 0.5).otherwise(near) + F.lit(0.0)  # no negative zero


def parse_units(text: Column) -> Column:
    """'1.2M' -> 1200000.0; suffixes K, M, B, T; sentinels and bad text -> 0.0."""
    value = F.upper(F.regexp_replace(strip(text), ",", ""))
    unit = F.regexp_extract(value, "([KMBT])$", 1)
    factor = (
        F.when(unit == "K", 1e3).when(unit == "M", 1e6)
        .when(unit == "B", 1e9).when(unit == "T", 1e12).otherwise(1.0)
    )
    number = safe_float(F.regexp_replace(value, "[KMBT]$", ""), extended=True)
    return F.coalesce(number * factor, F.lit(0.0))


def parse_volume(text: Column) -> Column:
    """Like :func:`parse_units` by the letters m, b, k in that order; bad -> NULL."""
    value = strip(F.lower(F.regexp_replace(text, ",", "")))

    def scaled(letter: str, factor: float) -> Column:
        return _as_number(strip(F.replace(value, F.lit(letter), F.lit("")))) * factor

    return (
        F.when(value.contains("m"), scaled("m", 1e6))
        .when(value.contains("b"), scaled("b", 1e9))
        .when(value.contains("k"), scaled("k", 1e3))
        .otherwise(_as_number(value))
    )


def to_numeric_coerce(value: Column) -> Column:
    """Number, or NULL where the text is none."""
    return _as_number(strip(value.cast("string")))


def price_direction(change: Column) -> Column:
    """1 for a rise, else 0."""
    return F.coalesce((change > 0).cast("int"), F.lit(0))
