"""Exact top-k inner products: ball trees per shard, searched by branch and bound."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewire.session import materialize

K = 5
#: Rows in a shard and queries in a block, about; a task holds one of each.
SHARD_ROWS = 4096
BLOCK_QUERIES = 4096
LEAF = 64
_EXACT = 2.0**53


def _finite(column: str) -> Column:
    return F.coalesce(
        F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)
    )


class BallTree:
    """Points in nested balls, halved along the line between two far points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []
        self._build(0, len(points))

    def _build(self, at: int, to: int) -> int:
        own = self.points[self.order[at:to]]
        center = own.mean(0)
        away = np.sqrt(((own - center) ** 2).sum(1))
        number = len(self.nodes)
        self.nodes.append(())
        children = ()
        if to - at > LEAF and away.max() > 0:
            far = own[away.argmax()]
            other = own[((own - far) ** 2).sum(1).argmax()]
            along = own @ (other - far)
            half = (to - at) // 2
            split = np.argpartition(along, half)
            self.order[at:to] = self.order[at:to][split]
            children = (self._build(at, at + half), self._build(at + half, to))
        # Rounding must not make a ball too small.
        self.nodes[number] = (center, float(away.max()) * (1 + 1e-9) + 1e-9, at, to, children)
        return number

    def bounds(self, node: int, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        center, radius, *_ = self.nodes[node]
        reach = np.abs(queries) @ np.abs(center)
        return queries @ center + norms * radius + 1e-9 * (reach + norms * radius) + 1e-6


def search(
    points: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (query number, id, score): each query's k best of these points.

    Scores under a query's ``floor`` may be left out. Equal scores go to the smaller id. A
    point with the query's own id is no candidate. All queries walk the tree together: a
    node is entered by those whose upper bound reaches their kth score so far, the child
    with the greater bounds first.
    """
    tree, norms = BallTree(points), np.sqrt((queries**2).sum(1))
    exact = np.abs(points).max(initial=0) * np.abs(queries).max(initial=0) * points.shape[1] < _EXACT
    if not exact:  # beyond what doubles hold
        whole_points = np.array([[int(x) for x in row] for row in points], object)
        whole = np.array([[int(x) for x in row] for row in queries], object)
    scores = np.full((len(queries), k), -np.inf)
    names = np.full((len(queries), k), np.iinfo(np.int64).max)
    best: list[list[tuple]] = [[] for _ in queries] if not exact else []
    kth = floor.astype(float).copy()
    everyone = np.arange(len(queries))
    waiting = [(0, everyone, tree.bounds(0, queries, norms))]
    while waiting:
        node, who, bound = waiting.pop()
        live = bound >= kth[who]
        who = who[live]
        if not len(who):
            continue
        _, _, at, to, children = tree.nodes[node]
        if children:
            both = [(c, who, tree.bounds(c, queries[who], norms[who])) for c in children]
            waiting += sorted(both, key=lambda x: x[2].sum())
            continue
        rows = tree.order[at:to]
        if exact:
            found = queries[who] @ points[rows].T
            found[own[who][:, None] == ids[rows][None, :]] = -np.inf
            some = (found >= np.maximum(kth[who], np.finfo(float).min)[:, None]).any(1)
            who, found = who[some], found[some]
            if not len(who):
                continue
            all_scores = np.hstack([scores[who], found])
            all_names = np.hstack([names[who], np.broadcast_to(ids[rows], found.shape)])
            order = np.lexsort((all_names, -all_scores), axis=1)[:, :k]
            scores[who] = np.take_along_axis(all_scores, order, 1)
            names[who] = np.take_along_axis(all_names, order, 1)
            kth[who] = np.maximum(floor[who], scores[who, -1])
        else:
            for q in who:
                fresh = [(-int(whole_points[r] @ whole[q]), ids[r]) for r in rows if ids[r] != own[q]]
                best[q] = sorted([*best[q], *fresh])[:k]
                if len(best[q]) == k:  # a double just below it
                    kth[q] = max(floor[q], np.nextafter(float(-best[q][-1][0]), -np.inf))
    if not exact:
        flat = [(q, name, -score) for q, own in enumerate(best) for score, name in own]
        return tuple(np.array([x[i] for x in flat], np.int64) for i in range(3))
    q, place = np.nonzero(scores > -np.inf)
    return q, names[q, place], scores[q, place].astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: float = 256.0) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k greatest inner products.

    Every entry x counts as floor(scale * x), x as a double, and scores are exact integers;
    a score beyond 64 bits is an error. Ties go to the smaller vec_id. Candidates are all
    rows but those of the query's own id, of equal vector length; there are fewer than k
    rows where there are fewer candidates. Vectors that are null or hold a null or an entry
    that is not finite take no part, nor do rows without an id. Rows that repeat an id are
    candidates each, and one query.

    Rows are dealt to shards and queries to blocks by a hash of the id and its place; a
    task builds the tree of one shard and takes one block through it. One shard for each
    block goes first; the kth scores found there prune all others from the start.
    """
    values = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = vectors.where(_finite("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), is_query.alias("_query"), values.alias("v"),
        F.size("embedding").alias("dim"),
    )
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()))
    asked = rows.where("_query").dropDuplicates(["vec_id"]).select(
        F.col("vec_id").alias("query_id"), "v", "dim"
    )
    asked = materialize(asked)
    n_shards = max(1, -(-rows.count() // SHARD_ROWS))
    n_blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    shard = F.pmod(F.xxhash64("vec_id", "_row"), F.lit(n_shards)).cast("int")
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int")
    first = F.col("block") % n_shards == F.col("shard")
    data = rows.select("vec_id", "v", "dim", shard.alias("shard"), numbers(n_blocks).alias("block"))
    ask = asked.select("query_id", "v", "dim", block.alias("block"), numbers(n_shards).alias("shard"))
    low = F.lit(float("-inf")).alias("floor")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in ("query_id", "vec_id", "score")})
        own = left["query_id"].to_numpy()
        q, name, score = search(
            np.stack(right["v"].to_numpy()), right["vec_id"].to_numpy(), np.stack(left["v"].to_numpy()),
            own, left["floor"].to_numpy(), k,
        )
        return pd.DataFrame({"query_id": own[q], "vec_id": name, "score": score})

    by = ["block", "shard", "dim"]

    def searched(queries: DataFrame, points: DataFrame) -> DataFrame:
        return queries.groupBy(*by).cogroup(points.groupBy(*by)).applyInPandas(
            run, "query_id long, vec_id long, score long"
        )

    start = materialize(searched(ask.where(first).select("*", low), data.where(first)))
    least = F.min("score").cast("double")
    kth = start.groupBy("query_id").agg(
        F.when((F.count("*") == k) & (F.abs(least) < _EXACT), least).alias("floor")
    )
    rest = searched(
        ask.where(~first).join(kth, "query_id", "left")
        .withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))),
        data.where(~first),
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        start.union(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
