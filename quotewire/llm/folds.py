"""Which rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def held_out(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """Whether crc32 of the key as text leaves this remainder; a null key does not."""
    code = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(code % modulus == remainder, F.lit(False))
