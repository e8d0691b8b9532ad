"""Forests of regression trees that grow level by level, all trees together.

Features are cut into at most 32 bins by their quantiles. Training rows with equal bins and
equal target are counted first, so what is passed over grows with the different rows only.
A level is one pass: each task adds its rows up by open node, feature and bin, the sums are
shuffled by node, the best split of a node is found where its sums meet, and the driver
learns the splits alone. A 0/1 target gives the splits of the Gini impurity, which is twice
its variance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.session import materialize, number_batches

BINS = 32
#: Equal rows that are drawn as one; more of them are drawn in several parts.
MOST_EQUAL = 64
#: Open nodes whose sums a task holds at once.
OPEN_NODES = 16_384
_ROWS = 16_384  # rows that step together
_BITS = 5
_U64 = np.uint64


def _cells(values: np.ndarray) -> np.ndarray:
    """Doubles as whole numbers of the same order that keep ten places of the fraction."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, -(bits & np.int64(2**63 - 1)), bits) >> 42


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> list[np.ndarray]:
    return [batch[c].cast(pa.float64()).to_numpy(zero_copy_only=False) for c in names]


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least so many, but for the last."""

    def whole() -> Iterator[pa.RecordBatch]:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= _ROWS:
            yield from whole()
            held, n = [], 0
    if n:
        yield from whole()


def bin_edges(rows: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Per feature the cells after which a bin ends: of equal counts, or all that occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            for i, values in enumerate(_columns(batch, features)):
                cell, n = np.unique(_cells(values), return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(cell), i)), pa.array(cell), pa.array(n)], names=["i", "cell", "n"])

    counts = rows.select(*features).mapInArrow(count, "i long, cell long, n long")
    with number_batches(rows.sparkSession):
        found = counts.groupBy("i", "cell").agg(F.sum("n").alias("n")).toPandas().sort_values(["i", "cell"])
    edges = []
    for i in range(len(features)):
        own = found[found["i"] == i]
        cell, upto = own["cell"].to_numpy(), own["n"].cumsum().to_numpy()
        if len(cell) > BINS:
            at = np.searchsorted(upto, upto[-1] * np.arange(1, BINS) / BINS)
            edges.append(np.unique(cell[at]))
        else:
            edges.append(cell[:-1])
    return edges


def _binned(columns: Sequence[np.ndarray], edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins, features x rows."""
    return np.stack([np.searchsorted(e, _cells(v)) for e, v in zip(edges, columns)])


def _bins_of(code: np.ndarray, width: int) -> np.ndarray:
    """Bins, features x rows, of the codes that hold them."""
    return np.stack([code >> _BITS * (width - 1 - i) & (1 << _BITS) - 1 for i in range(width)])


def counted_equal(
    rows: DataFrame, features: Sequence[str], target: str, edges: Sequence[np.ndarray], *by: str
) -> DataFrame:
    """Rows (by..., code of all bins, target as y, n): how many rows are equal in these.

    ``by`` are columns of true and false.
    """
    if len(features) * _BITS > 60:
        raise ValueError("too many features")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            *columns, y = _columns(batch, [*features, target])
            codes = np.zeros(len(y), np.int64)
            for own in _binned(columns, edges):
                codes = codes << _BITS | own
            yield pa.record_batch([*[batch[c] for c in by], pa.array(codes), pa.array(y)], names=[*by, "code", "y"])

    schema = ", ".join([*[f"{c} boolean" for c in by], "code long", "y double"])
    equal = rows.select(*features, target, *by).mapInArrow(code, schema)
    return equal.groupBy(*by, "code", "y").agg(F.count("*").alias("n"))


def _counted(rows: DataFrame, features: Sequence[str], target: str, edges: Sequence[np.ndarray]) -> DataFrame:
    """Rows (code of all bins, target, n), of at most :data:`MOST_EQUAL` equal ones each."""
    return _in_parts(counted_equal(rows, features, target, edges))


def _in_parts(equal: DataFrame) -> DataFrame:
    """:func:`counted_equal` rows in parts of at most :data:`MOST_EQUAL` equal ones, with a key each."""
    parts = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / MOST_EQUAL).cast("int"))
    return equal.select("code", "y", "n", F.explode(parts).alias("part")).select(
        "code", "y",
        F.least(F.lit(MOST_EQUAL), F.col("n") - F.col("part") * MOST_EQUAL).cast("int").alias("n"),
        F.xxhash64("code", "y", "part").alias("key"),
    )


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> _U64(shift))) * _U64(factor)
    return x ^ (x >> _U64(31))


@lru_cache(1)
def _draws() -> np.ndarray:
    """How often n equal rows are drawn, by n and 16 random bits: a Poisson law of mean n."""
    k = np.arange(256)
    logs = np.append(0.0, np.cumsum(np.log(k[1:])))
    u = (np.arange(1 << 16) + 0.5) / (1 << 16)
    table = [np.zeros(1 << 16, np.uint8)]
    for n in range(1, MOST_EQUAL + 1):
        table.append(np.searchsorted(np.cumsum(np.exp(k * np.log(n) - n - logs)), u).astype(np.uint8))
    return np.concatenate(table)


@dataclass
class Trees:
    """Nodes of all trees, the roots first. A leaf leads to itself, whatever its bin."""

    feature: np.ndarray
    edge: np.ndarray
    left: np.ndarray  # the right child comes next
    value: np.ndarray

    def arrays(self) -> tuple[np.ndarray, ...]:
        """What is broadcast: workers need not know this class by its module."""
        return self.feature, self.edge, self.left, self.value

    def at(self, flat: np.ndarray, base: np.ndarray, node: np.ndarray, steps: int) -> np.ndarray:
        """The nodes that rows reach; ``flat`` has all bins of a row side by side, from ``base`` on."""
        for _ in range(steps):
            right = flat.take(base + self.feature.take(node)) > self.edge.take(node)
            node = self.left.take(node) + right
        return node


@dataclass(frozen=True)
class ForestModel:
    trees: Trees
    edges: list[np.ndarray]
    features: tuple[str, ...]
    importances: np.ndarray
    n_trees: int
    depth: int

    def transform(self, rows: DataFrame, prediction: str) -> DataFrame:
        """``rows`` with the mean of the trees' leaves."""
        edges, features = self.edges, self.features
        return self._predicted(rows, prediction, lambda batch: _binned(_columns(batch, features), edges))

    def transform_counted(self, equal: DataFrame, prediction: str) -> DataFrame:
        """:meth:`transform` of :func:`counted_equal` rows of these features and edges."""
        width = len(self.features)
        return self._predicted(
            equal, prediction, lambda batch: _bins_of(batch["code"].to_numpy(zero_copy_only=False), width)
        )

    def _predicted(self, rows: DataFrame, prediction: str, bins: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
        """``bins``: features x rows of a batch."""
        shared = rows.sparkSession.sparkContext.broadcast(self.trees.arrays())
        width, n_trees, depth = len(self.features), self.n_trees, self.depth

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = Trees(*shared.value)
            for batch in gathered(batches):
                flat = np.ascontiguousarray(bins(batch).T.astype(np.uint8)).ravel()
                base = np.arange(batch.num_rows, dtype=np.int32) * width
                total = np.zeros(batch.num_rows)
                for tree in range(n_trees):
                    root = np.full(batch.num_rows, tree, np.int32)
                    total += trees.value.take(trees.at(flat, base, root, depth))
                yield pa.record_batch(
                    [*batch.columns, pa.array(total / n_trees)], names=[*batch.schema.names, prediction]
                )

        schema = T.StructType([*rows.schema.fields, T.StructField(prediction, T.DoubleType())])
        return rows.mapInArrow(predict, schema)


def _best(sums: np.ndarray, tried: np.ndarray) -> tuple[int, int, float, float, float, float]:
    """Feature, bin, gain, means on either side and own mean of a node's best split; bin -1: none.

    ``sums``: for each tried feature and bin the rows and the sum of targets, last the sum of squares.
    """
    n, s = sums[:-1].reshape(len(tried), BINS, 2).transpose(2, 0, 1)
    n, s = n.cumsum(1), s.cumsum(1)
    whole, total = n[0, -1], s[0, -1]
    n, s = n[:, :-1], s[:, :-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = s**2 / n + (total - s) ** 2 / (whole - n) - total**2 / whole
    gain = np.where((n > 0) & (n < whole), gain, -np.inf)
    top = gain.max()
    if not top > 1e-12 * sums[-1]:
        return -1, -1, 0.0, 0.0, 0.0, total / whole
    # The first of those that only the order of the sums tells apart.
    i, b = divmod(int(np.argmax(gain >= top - 1e-9 * abs(top))), BINS - 1)
    return (
        int(tried[i]), b, float(top), s[i, b] / n[i, b], (total - s[i, b]) / (whole - n[i, b]), total / whole
    )


_SPLIT = "slot long, feature int, edge int, gain double, low double, high double, mean double"


def fit(
    rows: DataFrame, features: Sequence[str], target: str, n_trees: int, depth: int, seed: int,
    tried: int | None = None,
) -> ForestModel:
    """Trees of rows drawn with replacement; a split is the best of ``tried`` features (None: of all).

    Draws depend on bins, target and number of equal rows, so the trees do not depend on
    where the rows lie. Targets count from their mean.
    """
    edges = bin_edges(rows, features)
    return fit_counted(
        counted_equal(rows, features, target, edges), edges, features, n_trees, depth, seed, tried
    )


def fit_counted(
    equal: DataFrame, edges: list[np.ndarray], features: Sequence[str], n_trees: int, depth: int, seed: int,
    tried: int | None = None,
) -> ForestModel:
    """:func:`fit` to :func:`counted_equal` rows, which may be of several fits."""
    with number_batches(equal.sparkSession):
        return _grown(materialize(_in_parts(equal)), edges, features, n_trees, depth, seed, tried)


def _grown(
    cells: DataFrame, edges: list[np.ndarray], features: Sequence[str], n_trees: int, depth: int, seed: int,
    tried: int | None,
) -> ForestModel:
    spark = cells.sparkSession
    centre = cells.agg(F.sum(F.col("n") * F.col("y")) / F.sum("n")).first()[0]
    table = spark.sparkContext.broadcast(_draws())
    k, width = tried or len(features), len(features)
    size = k * BINS * 2 + 1
    trees = Trees(*(np.zeros(n_trees, d) for d in (np.int32, np.uint8, np.int32, np.float64)))
    trees.edge[:], trees.left[:], trees.value[:] = BINS, np.arange(n_trees), centre
    of_tree, open_nodes = np.arange(n_trees), np.arange(n_trees)
    gains = np.zeros((n_trees, width))

    def choices(nodes: np.ndarray) -> np.ndarray:
        """The features that a node tries, nodes x k."""
        if k == width:
            return np.tile(np.arange(width), (len(nodes), 1))
        with np.errstate(over="ignore"):
            codes = nodes.astype(_U64)[:, None] * _U64(64) + np.arange(width, dtype=_U64) + _U64(seed << 40)
            return np.sort(np.argsort(_mix(codes * _U64(0x9E3779B97F4A7C15)), axis=1)[:, :k], axis=1)

    def level(step: int, nodes: np.ndarray) -> list:
        slot_of = np.full(len(trees.left), -1, np.int32)
        slot_of[nodes] = np.arange(len(nodes))
        sent = spark.sparkContext.broadcast((trees.arrays(), slot_of, of_tree[nodes], choices(nodes)))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            arrays, slot_of, owner, tries = sent.value
            trees = Trees(*arrays)
            slots = [np.flatnonzero(owner == t) for t in range(n_trees)]  # one run each
            sums, squares = np.zeros((2, len(owner) * k * BINS)), np.zeros(len(owner))

            def rows_in(code, y, n, key) -> None:
                bins = np.ascontiguousarray(_bins_of(code, width).T)
                flat, key = bins.astype(np.uint8).ravel(), key.view(_U64)
                if k == width:
                    places = (bins + np.arange(width) * BINS).astype(np.int32).T.copy()
                offset, drawn = n.astype(np.int32) << 16, -1
                for tree, own in enumerate(slots):
                    if not len(own):
                        continue
                    if drawn != tree // 4:
                        drawn = tree // 4
                        bits = _mix(key + _U64((seed * 1_000_003 + drawn + 1) * 0x9E3779B97F4A7C15 % 2**64))
                    weight = table.value.take(offset + (bits >> _U64(tree % 4 * 16) & _U64(0xFFFF)).astype(np.int32))
                    some = np.flatnonzero(weight)
                    base = (some * width).astype(np.int32)
                    slot = slot_of[trees.at(flat, base, np.full(len(some), tree, np.int32), step)]
                    inside = slot >= 0
                    if not inside.all():
                        some, base, slot = some[inside], base[inside], slot[inside]
                    w = weight[some].astype(np.float64)
                    wy = w * y[some]
                    first, last = own[0], own[-1] + 1
                    slot = slot - first
                    squares[first:last] += np.bincount(slot, wy * y[some], last - first)
                    if k == width:
                        place = (places.take(some, axis=1) + slot * (k * BINS)).ravel()
                    else:
                        place = np.concatenate([
                            flat.take(base + tries[:, j].take(slot + first)) + (slot * k + j) * BINS for j in range(k)
                        ])
                    part = slice(first * k * BINS, last * k * BINS)
                    for total, of in zip(sums, (w, wy)):
                        total[part] += np.bincount(place, np.tile(of, k), (last - first) * k * BINS)

            for batch in gathered(batches):
                code, y, n, key = (batch[c].to_numpy(zero_copy_only=False) for c in ("code", "y", "n", "key"))
                rows_in(code, y - centre, n, key)
            both = sums.reshape(2, len(owner), k * BINS).transpose(1, 2, 0)
            full = np.flatnonzero(both[:, :BINS, 0].sum(1))
            task = TaskContext.get().partitionId()
            for at in range(0, len(full), 1024):
                part = full[at : at + 1024]
                data = np.concatenate([both[part].reshape(len(part), -1), squares[part, None]], axis=1)
                yield pa.record_batch(
                    [pa.array(part), pa.array(np.full(len(part), task)), pa.array([d.tobytes() for d in data], pa.binary())],
                    names=["slot", "task", "sums"],
                )

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tries, out = sent.value[3], []
            now, total = None, np.zeros(size)
            for batch in batches:
                for slot, sums in zip(batch["slot"].to_pylist(), batch["sums"].to_pylist()):
                    if slot != now:
                        if now is not None:
                            out.append((now, *_best(total, tries[now])))
                        now, total = slot, np.zeros(size)
                    total += np.frombuffer(sums)
            if now is not None:
                out.append((now, *_best(total, tries[now])))
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), *[pa.float64()] * 4))],
                    names=["slot", "feature", "edge", "gain", "low", "high", "mean"],
                )

        parts = cells.mapInArrow(add, "slot long, task long, sums binary")
        met = parts.repartition("slot").sortWithinPartitions("slot", "task")  # in one order each time
        return sorted(met.mapInArrow(split, _SPLIT).collect())

    for step in range(depth):
        children, values, owners = [], [], []
        for at in range(0, len(open_nodes), OPEN_NODES):
            nodes = open_nodes[at : at + OPEN_NODES]
            for r in level(step, nodes):
                node = nodes[r["slot"]]
                trees.value[node] = centre + r["mean"]
                if r["edge"] >= 0:
                    gains[of_tree[node], r["feature"]] += r["gain"]
                    children.append((node, r["feature"], r["edge"]))
                    values += [centre + r["low"], centre + r["high"]]
                    owners += [of_tree[node]] * 2
        if not children:
            break
        split_at, feature, edge = np.array(children).T
        new = len(trees.left) + np.arange(len(values))
        trees.feature[split_at], trees.edge[split_at], trees.left[split_at] = feature, edge, new[::2]
        zeros = np.zeros(len(new), np.int32)
        trees = Trees(
            np.append(trees.feature, zeros), np.append(trees.edge, (zeros + BINS).astype(np.uint8)),
            np.append(trees.left, new.astype(np.int32)), np.append(trees.value, values),
        )
        of_tree, open_nodes = np.append(of_tree, owners), new
    shares = np.divide(gains, gains.sum(1, keepdims=True), out=np.zeros_like(gains), where=gains.sum(1, keepdims=True) > 0)
    total = shares.sum(0)
    return ForestModel(
        trees, edges, tuple(features), total / total.sum() if total.sum() else total, n_trees, depth
    )
