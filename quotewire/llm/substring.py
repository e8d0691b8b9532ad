"""Removal of word sequences that repeat within or across documents: seed and extend.

Seeds are winnowed anchors: of the 8-word grams inside every window of ``min_words`` words
the one of least hash is an anchor, so equal windows carry the same anchor at the same
place. An anchor's context is all windows that chose it, one stretch of words reaching out
to both sides. Occurrences of an anchor are joined and extended in two steps, neither of
which lists pairs: contexts that are equal as a whole repeat in every window; the different
contexts of one anchor are extended window by window, once for each distinct context,
however many documents hold it. The union of a document's repeated windows is its maximal
repeats.

Words are hashed to 64 bits, anchors with their contexts and windows to 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.llm.words import U64, WordHasher, append_columns, mix, ranges, set_aside, slices
from quotewire.session import materialize

MIN_WORDS = 35
GRAM = 8
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_SPACE = b" \t\n\x0b\x0c\r"


def text_key() -> dict[str, Column]:
    """128 bits that stand for a text; equal texts share all work. Null counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return {"_f1": F.xxhash64(text), "_f2": F.xxhash64(F.lit(1), text)}


class _Windows:
    """Hashes of word sequences, from running sums of polynomials over word hashes."""

    def __init__(self, words: np.ndarray):
        n, self.sums, self.down = len(words) + 1, [], []
        for base in _BASES:
            up, down = np.full(n, base, U64), np.full(n, pow(base, -1, 1 << 64), U64)
            up[0] = down[0] = 1
            up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
            total = np.zeros(n, U64)
            np.cumsum(words * up[:-1], out=total[1:])
            self.sums.append(total)
            self.down.append(down)

    def hash(self, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
        total = self.sums[which]
        return mix((total[ends] - total[starts]) * self.down[which][starts])


def _anchors(words: np.ndarray, heads: np.ndarray, size: int, gram: int):
    """Anchors of all windows: place of the gram, first and last window that chose it."""
    windows = _Windows(words)
    last = len(words) - size + 1  # windows that fit at all
    if last <= 0:
        empty = np.empty(0, np.int64)
        return windows, empty, empty, empty
    starts = np.arange(len(words) - gram + 1)
    grams = windows.hash(starts, starts + gram, 0)
    # Leftmost least gram among `span` ones, by doubling the stretch that is looked at.
    span, width, chosen = size - gram + 1, 1, starts
    while width < span:
        step = min(width, span - width)
        left, right = chosen[:-step], chosen[step:]
        chosen = np.where(grams[right] < grams[left], right, left)
        width += step
    row = np.repeat(np.arange(len(heads) - 1), np.diff(heads))
    at = np.arange(last)
    at = at[row[at] == row[at + size - 1]]
    place = chosen[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[at[1:]] != row[at[:-1]])
    ends = np.append(np.flatnonzero(new)[1:], len(at)) - 1
    return windows, place[new], at[new], at[ends] if len(at) else at


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def anchors(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """Rows (_f1, _f2, anchor, context, at): ``at`` is 1024 x first window + last - first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for part in slices(batch, "text"):
                words, heads = hasher.words(part["text"])
                windows, place, first, last = _anchors(words, heads, size, gram)
                row = np.searchsorted(heads, first, side="right") - 1
                context = windows.hash(first, last + size, 1) ^ mix(
                    (place - first).astype(U64) * U64(64) + (last - first).astype(U64) + U64(1)
                )
                keys = [part[c].take(pa.array(row)) for c in ("_f1", "_f2")]
                at = (first - heads[row]) * 1024 + (last - first)
                yield pa.record_batch(
                    [*keys, _signed(windows.hash(place, place + gram, 0)), _signed(context), pa.array(at)],
                    names=["_f1", "_f2", "anchor", "context", "at"],
                )

    return docs.select("_f1", "_f2", "text").mapInArrow(
        run, "_f1 long, _f2 long, anchor long, context long, at long"
    )


def _extended(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Rows (w1, w2, anchor, context, bit) of all windows of the ``wanted`` contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for part in slices(batch, "text"):
                words, heads = hasher.words(part["text"])
                windows, lists = _Windows(words), part["wanted"]
                row = np.repeat(np.arange(len(lists)), np.asarray(pa.compute.list_value_length(lists)))
                flat = lists.flatten()
                anchor, context, at = (np.asarray(flat.field(i)) for i in range(3))
                count = at % 1024 + 1
                starts = ranges(heads[row] + at // 1024, count)
                bit = ranges(np.zeros(len(count), np.int64), count)
                yield pa.record_batch(
                    [
                        *[_signed(windows.hash(starts, starts + size, i)) for i in (0, 1)],
                        pa.array(np.repeat(anchor, count)), pa.array(np.repeat(context, count)),
                        pa.array(np.left_shift(np.int64(1), bit)),
                    ],
                    names=["w1", "w2", "anchor", "context", "bit"],
                )

    lists = materialize(
        wanted.groupBy("_f1", "_f2").agg(
            F.collect_list(F.struct("anchor", "context", "at")).alias("wanted")
        )
    )
    rows = docs.select("_f1", "_f2", "text").join(lists, ["_f1", "_f2"])
    return rows.select("wanted", "text").mapInArrow(
        run, "w1 long, w2 long, anchor long, context long, bit long"
    )


def repeated_spans(docs: DataFrame, size: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """Rows (_f1, _f2, spans) of texts that hold a repeated window, in a written table.

    ``docs`` has ``text`` and the columns of :func:`text_key`. A span (at, mask) stands for
    the windows at ``at`` // 1024 + i for each bit i of ``mask``.
    """
    if not 0 < gram <= size <= gram + 62:
        raise ValueError("a window holds 1 to 63 grams")
    found = anchors(docs, size, gram)
    again = materialize(
        found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    )
    hits = materialize(found.join(again, "anchor"))
    contexts = materialize(
        hits.groupBy("anchor", "context").agg(
            F.count("*").alias("n"), F.first("_f1").alias("_f1"), F.first("_f2").alias("_f2"),
            F.first("at").alias("at"),
        )
    )
    mixed = materialize(
        contexts.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    )
    windows = materialize(_extended(docs, contexts.join(mixed, "anchor"), size))
    # Equal windows have one anchor, so two contexts that hold one are two places of it.
    shared = materialize(
        windows.groupBy("w1", "w2")
        .agg(F.min("context").alias("low"), F.max("context").alias("high"))
        .where("low <> high").select("w1", "w2")
    )
    partly = windows.join(shared, ["w1", "w2"]).groupBy("anchor", "context").agg(
        F.bit_or("bit").alias("mask")
    )
    whole = F.expr("shiftrightunsigned(-1L, cast(63 - at % 1024 AS int))")
    status = materialize(
        contexts.join(partly, ["anchor", "context"], "left")
        .select("anchor", "context", F.when(F.col("n") > 1, whole).otherwise(F.col("mask")).alias("mask"))
        .where("mask <> 0")
    )
    return materialize(
        hits.join(status, ["anchor", "context"])
        .groupBy("_f1", "_f2").agg(F.collect_set(F.struct("at", "mask")).alias("spans"))
    )


def _kept(text: bytes, spans: list[tuple[int, int]], size: int) -> tuple[int, int, bytes]:
    words = text.split()
    if not spans:
        return len(words), 0, b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.array([s[0] for s in spans]) // 1024
    mask = np.array([s[1] for s in spans])
    bits = (mask[:, None] >> np.arange(64)) & 1
    which, bit = np.nonzero(bits)
    starts = at[which] + bit
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    stay = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
    return len(words), len(words) - len(stay), b" ".join([words[i] for i in stay])


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept", T.StringType()),
]


def remove_repeats(docs: DataFrame, size: int = MIN_WORDS, gram: int = GRAM,
                   keep_text: bool = False) -> DataFrame:
    """``docs`` with n_words, n_removed and kept: the words left, joined by one space.

    Words are runs of characters other than ASCII white space, unchanged. Every word
    covered by a window of ``size`` words whose sequence also starts anywhere else, in the
    same document or another, goes; both places go. Null and empty texts have no words and
    keep "". Texts shorter than a window lose nothing. Rows are never dropped, and equal
    rows count as separate documents; ids play no part. Columns named like the new ones
    are replaced. ``text`` itself stays only if asked for.
    """
    docs, restore = set_aside(docs, replaced={f.name for f in FIELDS})
    docs = docs.withColumns(text_key())
    spans = repeated_spans(docs, size, gram)

    def make():
        def kept(part: pa.RecordBatch) -> list[pa.Array]:
            spans = part["spans"]
            lengths = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(spans), 0))
            ends, flat = np.cumsum(lengths), spans.flatten()
            at, mask = (np.asarray(flat.field(i)) for i in (0, 1))
            out = []
            for text, n, end in zip(part["text"].cast(pa.binary()).to_pylist(), lengths, ends):
                own = list(zip(at[end - n : end], mask[end - n : end])) if n else []
                out.append(_kept(text or b"", own, size))
            n_words, n_removed, words = zip(*out)
            return [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(words, pa.binary()).cast(pa.string())]

        return kept

    marked = docs.join(spans, ["_f1", "_f2"], "left")
    return restore(append_columns(marked, make, FIELDS, keep_text).drop("_f1", "_f2", "spans"))
