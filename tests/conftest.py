import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quotewire.session import build_session

    session = build_session(
        "quotewire-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column function of literal arguments."""
    from pyspark.sql import functions as F

    def value(function, *args, kinds=None):
        columns = [F.lit(a).cast(k) if k else F.lit(a) for a, k in zip(args, kinds or [None] * len(args))]
        return spark.range(1).select(function(*columns).alias("v")).first()["v"]

    return value


def rows(df, *columns):
    """Rows of a frame as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
