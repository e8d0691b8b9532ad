"""Spark-native analytics that relate news text to market quotes."""

import sys

from pyspark import cloudpickle

from quotewire.session import build_session, configure

# Functions that run in Python workers travel there whole, so the package need only be
# installed where the driver runs.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "configure"]
