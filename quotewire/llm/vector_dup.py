"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points in order. An inverted list holds
the vectors of one label that have the same three pivots among their nearest six, so two
vectors meet exactly if they share at least three pivots, and the count itself needs no
pass over all pairs of a pivot's list. What meets is verified by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewire.llm.graph import components
from quotewire.llm.near_dup import _whole_groups
from quotewire.session import materialize

SIMILARITY = 0.98
PIVOTS = 128
#: Vectors looked at for pivots; the index covers all rows whatever this is.
PIVOT_SAMPLE = 2048
NEAREST = 6
SHARED = 3
CHUNK = 1024
#: No two pivots are more alike, or vectors near both would order them by chance.
PIVOT_APART = 0.6


def _vectors(lists: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(-1, dim)


def _usable(column: str):
    """Whether a vector has a direction: entries all finite, not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def pivots(nodes: DataFrame, dim: int) -> np.ndarray:
    """Unit reference points: sampled vectors that lie apart, then random directions."""
    sample = (
        nodes.where(F.col("dim") == dim).orderBy("_f1", "_f2").limit(PIVOT_SAMPLE)
        .select("vector").toArrow()["vector"].combine_chunks()
    )
    found = _vectors(sample, dim)
    out = np.empty((0, dim))
    for v in found:
        if len(out) < PIVOTS and (not len(out) or (out @ v).max() < PIVOT_APART):
            out = np.vstack([out, v])
    rest = np.random.RandomState(7).standard_normal((PIVOTS - len(out), dim))
    return np.vstack([out, rest / np.linalg.norm(rest, axis=1, keepdims=True)])


def _keys(nodes: DataFrame, points: dict[int, np.ndarray]) -> DataFrame:
    """``nodes`` with the sorted keys of all lists each vector is in."""
    shared = nodes.sparkSession.sparkContext.broadcast(points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picks = np.array(list(combinations(range(NEAREST), SHARED)))
        for batch in batches:
            dims, keys = batch["dim"].to_numpy(), [None] * batch.num_rows
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                own = _vectors(batch["vector"].take(pa.array(rows)), dim)
                near = np.argsort(-(own @ shared.value[int(dim)].T), axis=1, kind="stable")
                sets = np.sort(near[:, :NEAREST][:, picks], axis=2)
                codes = np.sort(sets @ (PIVOTS ** np.arange(SHARED)), axis=1)
                for row, code in zip(rows, codes):
                    keys[row] = code
            yield pa.record_batch(
                [*batch.columns, pa.array(keys, pa.list_(pa.int64()))], names=[*batch.schema.names, "keys"]
            )

    return nodes.mapInArrow(
        run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
        + ", keys array<long>"
    )


def _forest(linked: np.ndarray) -> np.ndarray:
    """For each of a few points the first one that a chain of links reaches."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(label)).min(1, initial=len(label))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(lists: DataFrame, similarity: float) -> DataFrame:
    """Rows (a, b, n): ``a`` got ``n`` links in a block, and a chain of links ties it to b."""
    by = ["dim", "label", "key", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, by):
            new = np.zeros(table.num_rows, bool)
            new[0] = True
            for c in by:
                values = table[c].to_numpy()
                new[1:] |= values[1:] != values[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], table.num_rows)
            node, chunk, copies = (table[c].to_numpy() for c in ("node", "chunk", "copies"))
            one, two, code = (table[c].to_numpy() for c in ("i", "j", "key"))
            dims = table["dim"].to_numpy()
            vectors, keys = table["vector"].combine_chunks(), table["keys"].combine_chunks()
            out = [(np.empty(0, np.int64),) * 3]
            for at, to in zip(starts, ends):
                if to - at < 2:
                    continue
                own = _vectors(vectors.slice(at, to - at), dims[at])
                alike = own @ own.T >= similarity
                np.fill_diagonal(alike, False)
                if one[at] != two[at]:
                    alike &= chunk[at:to, None] != chunk[None, at:to]
                if not alike.any():
                    continue
                sets = keys.slice(at, to - at).flatten().to_numpy().reshape(to - at, -1)
                root = _forest(alike)
                seen = _share_earlier(sets, code[at])
                n = (alike & ~seen).astype(np.float64) @ copies[at:to]
                out.append((node[at:to], node[at:to][root], n.astype(np.int64)))
            a, b, n = (np.concatenate(x) for x in zip(*out))
            some = (a != b) | (n > 0)
            yield pa.record_batch([pa.array(x[some]) for x in (a, b, n)], names=["a", "b", "n"])

    return (
        lists.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a long, b long, n long")
    )


def _share_earlier(sets: np.ndarray, key: int) -> np.ndarray:
    """Whether two rows also meet in a list of smaller key, where their link was counted."""
    out = np.zeros((len(sets), len(sets)), bool)
    names, place, often = np.unique(sets, return_inverse=True, return_counts=True)
    place = place.reshape(sets.shape)
    wanted = np.flatnonzero((names < key) & (often > 1))
    for at in range(0, len(wanted), 256):
        some = np.full(len(names), -1)
        some[wanted[at : at + 256]] = np.arange(len(wanted[at : at + 256]))
        row, column = np.nonzero(some[place] >= 0)
        member = np.zeros((len(sets), 256), np.float32)
        member[row, some[place[row, column]]] = 1
        out |= member @ member.T > 0
    return out


def near_duplicate_vectors(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of ``vectors``.

    Rows link if their labels are equal and not null, their vectors equally long, and the
    cosine in double precision is at least ``similarity``. Vectors that are null, empty,
    zero, or hold a null or an entry that is not finite link with nothing. ``n_links``
    counts the other rows linked directly, ``component_id`` is the smallest vec_id that
    links reach, own one included; null ids are passed over, and a component of null ids
    has none. Rows of equal label and vector are compared once and counted each.

    Links are found where two vectors share three of their nearest six of 128 pivots,
    which nearly all pairs this alike do; none is reported that is not verified.
    """
    rows = vectors.select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("vector")
    )
    good = _usable("vector") & F.col("label").isNotNull()
    hashes = {"_f1": F.xxhash64("vector"), "_f2": F.xxhash64(F.lit(1), "vector")}
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    # Scaled by the largest entry first, so that no square overflows or vanishes.
    largest = F.array_max(F.transform("vector", F.abs))
    unit = rows.where(good).withColumns(hashes).withColumn(
        "vector", F.transform("vector", lambda x: x / largest)
    )
    unit = unit.groupBy("label", "_f1", "_f2").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    nodes = materialize(
        unit.withColumn("_norm", norm)
        .withColumn("vector", F.transform("vector", lambda x: x / F.col("_norm")))
        .select("label", "_f1", "_f2", "least", "copies", "vector", F.size("vector").alias("dim"),
                F.monotonically_increasing_id().alias("node"))
    )
    dims = [r["dim"] for r in nodes.select("dim").distinct().collect()]
    points = {dim: pivots(nodes, dim) for dim in dims}
    held = materialize(_keys(nodes.select("node", "label", "dim", "copies", "vector"), points))
    posts = held.select("node", "label", "dim", F.explode("keys").alias("key"))
    lists = materialize(
        posts.groupBy("dim", "label", "key").agg(F.count("*").alias("n")).where("n > 1")
    )
    blocks = F.ceil(F.col("n") / CHUNK).cast("int")
    placed = (
        posts.join(lists, ["dim", "label", "key"])
        .withColumn("chunk", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("dim", "label", "key", "node", "chunk", F.least("chunk", "other").alias("i"),
                F.greatest("chunk", "other").alias("j"))
    )
    found = materialize(_links(
        placed.join(held.select("node", "copies", "vector", "keys"), "node"), similarity
    ))
    ties = components(found.select("a", "b"))
    counts = found.groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "node")
    member = nodes.join(ties, "node", "left").join(counts, "node", "left").select(
        "label", "_f1", "_f2", "least", F.coalesce("component", "node").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    member = materialize(member)
    heads = materialize(member.groupBy("component").agg(F.min("least").alias("component_id")))
    fate = materialize(
        member.join(heads, "component").select("label", "_f1", "_f2", "n_links", "component_id")
    )
    # Rows that link with nothing are told apart by a null label.
    keyed = rows.select("vec_id", F.when(good, F.col("label")).alias("label"),
                        *[c.alias(n) for n, c in hashes.items()])
    return keyed.join(fate, ["label", "_f1", "_f2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
