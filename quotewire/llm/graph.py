"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewire.session import materialize


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rows (node, component) of all nodes of ``links`` (a, b); the smallest node names it.

    ``known`` holds the components of links found before, which then need not be in
    ``links`` again.

    Large-star and small-star steps in turn (Kiveris et al., 2014): each node ties its
    larger neighbours, then its smaller ones, to the least node it knows, until all ties
    are stars. A step groups by node with map-side minima, so a hub that holds much of
    the links sends one row per task, and joins the ties to those minima. Each round's
    ties are written to the shared folder, so lineage stays short.
    """
    ties = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    if known is not None:
        ties = ties.union(known.select("node", "component"))
    ties, before = materialize(ties.where("a <> b").distinct()), None
    while True:
        now = _digest(ties)
        if now == before or not now[0]:
            break
        before = now
        large = _star(ties.union(ties.select("b", "a")), larger=True)
        ties = materialize(_star(large, larger=False))
    low = ties.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return ties.select(F.col("a").alias("node"), F.col("b").alias("component")).union(low)


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Tie the larger (else all, of larger-first pairs) neighbours of each node to its minimum."""
    pairs = pairs.toDF("n", "m")
    least = pairs.groupBy("n").agg(F.min("m").alias("least"))
    least = least.select(F.struct("n").alias("key"), F.least("n", "least").alias("least"))
    # The wrapped key keeps Spark from joining where the minima lie, which could not be split.
    joined = pairs.withColumn("key", F.struct("n")).join(least, "key")
    if larger:
        ties = joined.where("m > n").select(F.col("m").alias("a"), F.col("least").alias("b"))
    else:
        ties = joined.select(F.explode(F.array("m", "n")).alias("a"), F.col("least").alias("b"))
    return ties.where("a <> b").distinct()


def _digest(ties: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(ties.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first())
