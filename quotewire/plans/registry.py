"""All queries, registered by importing the modules that define them."""

from quotewire.plans import (  # noqa: F401
    page_queries,
    run_queries,
    scalar_queries,
    table_queries,
)
from quotewire.plans.catalog import QUERIES, run

__all__ = ["QUERIES", "run"]
