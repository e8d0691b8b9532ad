"""Helpers for writing column functions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used.

    Spark shares common parts of an expression, but not those under a condition, nor
    what a lambda refers to: that is worked out for every element.
    """
    return F.transform(F.array(value), use)[0]
