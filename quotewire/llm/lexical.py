"""Ranked lexical search, reversed: documents stream through an index of the items' terms.

The items are the small side. Their inverted index (term -> items that hold it) is
broadcast, in blocks of bounded size; every task takes its documents' term counts through
it and keeps a bounded heap per item. The heaps of all tasks are merged at the end.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotewire.llm.words import ranges, raw, slices
from quotewire.session import materialize

K = 10
#: Places of terms in items, and items, that one broadcast index holds, about.
INDEX_PLACES = 1 << 20
INDEX_ITEMS = 4096
#: Heaps of one item are merged in this many parts first.
MERGE_PARTS = 64
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WINDOW = 1 << 22  # bytes of one text split at once
_CELLS = 1 << 22  # scores, or places added to scores, held at once
_DOCUMENTS, _TERMS = -1, -2  # what the first pass counts besides terms
# All ASCII but letters and digits parts terms; bytes from 0x80 on belong to them.
_PLAIN = bytes(
    ord(chr(i).lower()) if chr(i).isalnum() or i >= 0x80 else 0x20 for i in range(0x80)
) + bytes(range(0x80, 0x100))


class Index:
    """Terms of items, and for each term the items that hold it and how often."""

    def __init__(self, terms: list[bytes], item: np.ndarray, n: np.ndarray, items: pa.Array):
        """Places of terms: the term, a position in ``items`` and the number of occurrences."""
        self.items = items
        self.numbers = {t: i for i, t in enumerate(sorted(set(terms)))}
        of = np.fromiter(map(self.numbers.__getitem__, terms), np.int64, len(terms))
        order = np.argsort(of, kind="stable")
        self.item, self.n = item[order].astype(np.int64), n[order].astype(np.int64)
        self.lengths = np.bincount(of, minlength=len(self.numbers))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, terms and occurrences of the index's terms in texts; each text's number of terms.

        Sorted by row, then term. Long texts are parted a window at a time.
        """
        data, offsets = raw(column)
        plain, get = data.tobytes().translate(_PLAIN), self.numbers.get
        sizes = np.zeros(len(column), np.int64)
        found, row = [], []
        short: list[list[bytes]] = []

        def look_up() -> None:
            total = int(sum(map(len, short)))
            found.append(np.fromiter(map(get, chain.from_iterable(short), repeat(-1)), np.int64, total))
            short.clear()

        for i in range(len(column)):
            at, end = int(offsets[i]), int(offsets[i + 1])
            while at < end:
                cut = plain.find(b" ", at + _WINDOW, end) if end - at > _WINDOW else -1
                own = plain[at : cut if cut >= 0 else end].split()
                short.append(own)
                row.append((i, len(own)))
                at = cut if cut >= 0 else end
                if at < end or len(own) > _WINDOW // 8:
                    look_up()
        look_up()
        if not row:
            return (*(np.empty(0, np.int64) for _ in range(3)), sizes)
        rows, lengths = np.array(row, np.int64).T
        np.add.at(sizes, rows, lengths)
        term = np.concatenate(found)
        hit = term >= 0
        key = np.repeat(rows, lengths)[hit] * len(self.numbers) + term[hit]
        key, times = np.unique(key, return_counts=True)
        return key // max(1, len(self.numbers)), key % max(1, len(self.numbers)), times, sizes


class Heaps:
    """The k best (score, document) of each item: higher scores, then smaller ids, null last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.ones(n_items, np.int64)
        self.heaps: list[list[tuple]] = [[] for _ in range(n_items)]

    def update(self, scores: np.ndarray, ids: pa.Array) -> None:
        """Take in the scores (rows x items) of documents; only those above 0 count."""
        least = self.floor
        if len(scores) > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=0)[-self.k])
        for r, i in zip(*np.nonzero(scores >= least)):
            name = ids[int(r)].as_py()
            entry = (int(scores[r, i]), name is not None, -name if name is not None else 0)
            heap = self.heaps[i]
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.floor[i] = heap[0][0]

    def rows(self) -> tuple[list[int], list[int | None], list[int]]:
        flat = [(i, e) for i, heap in enumerate(self.heaps) for e in heap]
        return (
            [i for i, _ in flat], [-e[2] if e[1] else None for _, e in flat], [e[0] for _, e in flat]
        )


def _scores(
    index: Index, weights: np.ndarray, n_docs: int, n_terms: int, column: pa.Array
) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, scores of rows x items) for parts of a column that fit in memory."""
    rows, terms, times, sizes = index.counts(column)
    lengths = 100 - 75 + (75 * sizes * n_docs) // n_terms
    gains = weights[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * lengths[rows]))
    n_items = len(index.items)
    step = max(1, _CELLS // max(1, n_items))
    ends = np.cumsum(index.lengths[terms])
    for first in range(0, len(column), step):
        last = min(len(column), first + step)
        scores = np.zeros((last - first) * n_items, np.int64)
        at, end = np.searchsorted(rows, [first, last])
        while at < end:
            before = ends[at - 1] if at else 0
            to = min(end, max(at + 1, int(np.searchsorted(ends, before + _CELLS, side="right"))))
            own = terms[at:to]
            places = ranges(index.starts[own], index.lengths[own])
            of = np.repeat(np.arange(at, to), index.lengths[own])
            np.add.at(scores, (rows[of] - first) * n_items + index.item[places], gains[of] * index.n[places])
            at = to
        yield first, scores.reshape(last - first, n_items)


def _counted(docs: DataFrame, shared) -> dict[int, int]:
    """Documents that hold each term, documents that hold any, and all terms of all documents.

    One row per term and task at most reaches the shuffle, one per term the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value)
        holders = np.zeros(len(index.numbers), np.int64)
        documents = terms = 0
        for batch in batches:
            for part in slices(batch, "text"):
                _, found, _, sizes = index.counts(part["text"])
                holders += np.bincount(found, minlength=len(holders))
                documents += int((sizes > 0).sum())
                terms += int(sizes.sum())
        at = np.flatnonzero(holders)
        yield pa.record_batch(
            [pa.array([_DOCUMENTS, _TERMS, *at], pa.int64()), pa.array([documents, terms, *holders[at]], pa.int64())],
            names=["term", "n"],
        )

    sums = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in sums.collect()}


def _best(docs: DataFrame, parts: tuple, k: int, kind: str) -> DataFrame | None:
    """Each task's best (item_id, doc_id, score) of one index; None if no document has a term."""
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    counts = _counted(docs, shared)
    n_docs, n_terms = counts.get(_DOCUMENTS, 0), counts.get(_TERMS, 0)
    if not n_terms:
        return None
    weights = np.zeros(len(set(parts[0])), np.int64)
    for term, holders in counts.items():
        if term >= 0:
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(*shared.value)
        heaps = Heaps(len(own.items), k)
        for batch in batches:
            for part in slices(batch, "text"):
                for first, scores in _scores(own, weights, n_docs, n_terms, part["text"]):
                    heaps.update(scores, part["doc_id"].slice(first, len(scores)))
        item, doc, score = heaps.rows()
        yield pa.record_batch(
            [own.items.take(pa.array(item, pa.int64())), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
            names=["item_id", "doc_id", "score"],
        )

    return docs.mapInArrow(run, f"item_id {kind}, doc_id long, score long")


def item_terms(items: DataFrame) -> DataFrame:
    """Rows (item_id, term, n): how often each item holds each of its terms.

    Rows that repeat an item wholly count once. Rows of one item_id with several texts are
    one item with the terms of all; a null item_id is an id like any other.
    """
    small = F.translate("text", CAPITALS, SMALL)
    terms = F.explode(F.regexp_extract_all(small, F.lit(f"({TERM})"), F.lit(1))).alias("term")
    return (
        items.select("item_id", "text").distinct().select("item_id", terms)
        .groupBy("item_id", "term").agg(F.count("*").alias("n"))
    )


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): each item's k documents of the highest scores.

    Terms are maximal runs of letters, digits and all that is not ASCII, A to Z lower-cased.
    A term weighs floor(1000 ln((2N + 2) / (2 df + 1))) by the N documents with a term and
    the df documents that hold it; a document's score sums weight x (1e9 tf div (1000 tf +
    8 m)) over the item's terms, repeats included, where m is 25 + 75 n N div L for its n
    of all L terms. All is 64-bit integer but the logarithm.

    Every row of ``docs`` is a document, repeats too; doc_id counts as a long. Scores must
    be above 0; equal ones go by ascending doc_id, null last. A null or empty text has no
    terms. Items without terms, or without a document that holds one, have no rows. Other
    columns are ignored.

    Documents are read twice for each block of items: for N, L and df, then for scores. A
    task holds one index and one heap per item, whatever the table's size.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    places = materialize(item_terms(items))
    size = places.agg(F.count("*").alias("places"), F.countDistinct(F.struct("item_id")).alias("items")).first()
    blocks = max(1, -(-size["places"] // INDEX_PLACES), -(-size["items"] // INDEX_ITEMS))
    found = []
    for block in range(blocks):
        own = places.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        if not own.num_rows:
            continue
        coded = own["item_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        terms = own["term"].cast(pa.binary()).to_pylist()
        parts = terms, coded.indices.to_numpy(), own["n"].to_numpy(), coded.dictionary
        best = _best(docs, parts, k, kind)
        if best is not None:
            found.append(best if blocks == 1 else materialize(best))
    if not found:
        empty = f"item_id {kind}, rank int, doc_id long, score long"
        return docs.sparkSession.createDataFrame([], empty)
    merged = found[0]
    for other in found[1:]:
        merged = merged.union(other)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS))
    few = merged.withColumn("_part", part)
    few = few.withColumn("rank", F.row_number().over(W.partitionBy("item_id", "_part").orderBy(*order)))
    few = few.where(F.col("rank") <= k)
    best = F.row_number().over(W.partitionBy("item_id").orderBy(*order))
    return (
        few.withColumn("rank", best).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
    )
