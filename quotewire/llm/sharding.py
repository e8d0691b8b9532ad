"""A reproducible shuffle into shards: a Feistel permutation of global row numbers.

Everything is DataFrame functions. Rows get a global number, 0 to n - 1, that depends on
their content only; a keyed permutation of 0 to n - 1 then gives each its place. The place
fixes shard and slot, and both can be computed from the number alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewire.session import materialize

SHARDS = 24
ROUNDS = 8
#: Steps of a cycle walk. Each ends it with a chance of a half at least.
WALKS = 96
#: Rows numbered by one task, about, and copies of one row made by one task at most.
BUCKET_ROWS = 50_000


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """One 62-bit key a round; the last bit tells which half the round changes."""
    out = []
    for i in range(rounds):
        digest = hashlib.sha256(f"{seed}/{i}".encode()).digest()
        out.append((int.from_bytes(digest[:8], "big") >> 3) << 1 | (i & 1))
    return out


def permuted(number: Column, n: int, seed: int) -> Column:
    """The place of each ``number`` in a keyed permutation of 0 to n - 1.

    A Feistel network permutes the numbers of the least even power of two that holds n,
    or half of it; a result of n or more is permuted again until it falls below, so the
    walk stays on its cycle and the whole is one to one.
    """
    bits = max(2, (n - 1).bit_length())
    low = bits // 2
    low_mask, high_mask = (1 << low) - 1, (1 << (bits - low)) - 1
    keys = F.array(*[F.lit(k).cast("long") for k in round_keys(seed)])

    def step(s: Column, key: Column) -> Column:
        left = s["l"].bitwiseXOR(F.xxhash64(s["r"], key).bitwiseAND(F.lit(high_mask).cast("long")))
        right = s["r"].bitwiseXOR(F.xxhash64(s["l"], key).bitwiseAND(F.lit(low_mask).cast("long")))
        odd = key.bitwiseAND(F.lit(1).cast("long")) == 1
        return F.when(odd, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), right.alias("r"))
        )

    def once(x: Column) -> Column:
        start = F.struct(
            F.shiftright(x, low).alias("l"), x.bitwiseAND(F.lit(low_mask).cast("long")).alias("r")
        )
        return F.aggregate(keys, start, step, lambda s: F.shiftleft(s["l"], low).bitwiseOR(s["r"]))

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), once(number.cast("long")),
        lambda x, _: F.when(x < n, x).otherwise(once(x)),
    )
    return F.when(walked < n, walked).otherwise(
        F.raise_error(F.lit(f"no place after {WALKS} steps; choose another seed")).cast("long")
    )


def numbered(rows: DataFrame, columns: Sequence[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """``columns`` of ``rows`` with a global number, 0 to n - 1, and n.

    Equal rows are counted before they are shuffled, dealt into buckets by a hash and
    numbered there in the order of ``columns``; a running sum over the sizes of the
    buckets does the rest. So the number depends on the table's content, not on how its
    rows are stored, and no key sends more than one row per task to another.
    """
    counted = materialize(
        rows.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("_copies"))
    )
    n = counted.agg(F.sum("_copies")).first()[0] or 0
    buckets = max(1, -(-n // BUCKET_ROWS))
    dealt = counted.withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    sizes = dealt.groupBy("_bucket").agg(F.sum("_copies").alias("_size"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)  # a row per bucket
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy("_bucket").orderBy(*columns).rowsBetween(W.unboundedPreceding, -1)
    ranked = dealt.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    placed = ranked.join(starts, "_bucket").withColumn("_first", F.col("_start") + F.col("_before"))
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / BUCKET_ROWS))
    last = F.least(F.lit(BUCKET_ROWS).cast("long"), F.col("_copies") - F.col("_part") * BUCKET_ROWS) - 1
    spread = placed.withColumn("_part", F.explode(parts))
    # Copies of one row beyond a bucket's worth are made by several tasks.
    crowded = F.col("_copies") > BUCKET_ROWS
    spread = spread.where(~crowded).union(spread.where(crowded).repartition("_first", "_part"))
    number = F.col("_first") + F.col("_part") * BUCKET_ROWS + F.col("_copy")
    return (
        spread.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .select(*columns, number.cast("long").alias(name)), n,
    )


def shard(
    rows: DataFrame, columns: Sequence[str], n_shards: int = SHARDS, seed: int = 0
) -> DataFrame:
    """``columns`` of every row with row_number, shard and slot.

    Shards differ by one row at most; slots run from 0 without gaps. The same content
    gives the same result however it is stored; repeated rows get a place each. Nulls
    compare as equal. ``columns`` that have an output's name are an error; other columns
    are dropped.
    """
    clash = {"row_number", "shard", "slot"} & set(columns)
    if clash:
        raise ValueError(f"columns named like the result: {sorted(clash)}")
    table, n = numbered(rows, columns)
    place = permuted(F.col("row_number"), max(n, 1), seed)
    return table.withColumn("_place", place).select(
        *columns, "row_number", F.pmod("_place", F.lit(n_shards)).cast("int").alias("shard"),
        F.floor(F.col("_place") / n_shards).cast("long").alias("slot"),
    )


def text_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, size (UTF-8 bytes of the text plus 8) and crc32 of each text; null is empty."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
