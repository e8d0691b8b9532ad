"""Words of whole texts as 64-bit hashes, taken from Arrow buffers a block at a time.

A word is a maximal run of characters other than ASCII white space (space, \\t to \\r).
All but :func:`append_columns` and :func:`set_aside` runs inside tasks and knows nothing
of Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import types as T

BLOCK_BYTES = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (finaliser of splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def slices(
    batch: pa.RecordBatch, column: str, max_bytes: int = 4 * BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold at most ``max_bytes`` together, or one row."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0))
    total, first = np.cumsum(sizes, dtype=np.int64), 0
    while first < batch.num_rows:
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + max_bytes, side="right")))
        yield batch.slice(first, last - first)
        first = last


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column without its nulls' place, and the offsets of its rows."""
    if column.null_count:
        column = pa.compute.fill_null(column, "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


class WordHasher:
    """Hashes every word of a column; equal words get equal hashes in every task.

    The hash of a word is that of its bytes as a polynomial over random 64-bit codes,
    modulo 2**64, so all words of a block come from one running sum. With ``letters`` a
    word is a run of letters only, where all non-ASCII counts as letters, and ASCII
    capitals equal small ones.
    """

    def __init__(self, block_bytes: int = BLOCK_BYTES, letters: bool = False):
        codes = np.random.RandomState(20240607).randint(0, 1 << 62, 256).astype(U64)
        self.codes = codes * U64(4) + U64(3)
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        if letters:
            small = np.arange(ord("a"), ord("z") + 1)
            self.codes[small - 32] = self.codes[small]
            self.space[:128] = True
            self.space[small] = self.space[small - 32] = False
        self.block_bytes = block_bytes
        self._powers(block_bytes + 1)

    def _powers(self, n: int) -> None:
        base = 0x9E3779B97F4A7C15
        inverse = pow(base, -1, 1 << 64)
        steps = np.full(n, base, U64), np.full(n, inverse, U64)
        for s in steps:
            s[0] = 1
        self.up, self.down = (np.multiply.accumulate(s) for s in steps)

    def _cuts(self, space: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of about a block that no word crosses."""
        n, at = len(space), 0
        while at < n:
            end = min(n, at + self.block_bytes)
            if end < n:
                gaps = np.flatnonzero(space[at:end])
                row = offsets[np.searchsorted(offsets, end, side="right") - 1]
                best = max(int(gaps[-1]) + at + 1 if len(gaps) else 0, int(row))
                if best <= at:  # one word fills the block
                    later = np.flatnonzero(space[end:])[:1]
                    best = min(
                        end + int(later[0]) if len(later) else n,
                        int(offsets[np.searchsorted(offsets, end, side="right")]),
                    )
                end = best
            yield at, end
            at = end

    def words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and for each row the number of its first word.

        The second array has one more entry than the column, the number of words.
        """
        data, offsets = raw(column)
        hashes, starts, _ = self.spans(data, offsets)
        return hashes, np.searchsorted(starts, offsets)

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and end of all words of texts that lie end to end, as :func:`raw` gives them."""
        space = self.space[data]
        parts, starts, ends = [], [], []
        for at, end in self._cuts(space, offsets):
            if end - at >= len(self.up):
                self._powers(end - at + 1)
            text, gap = data[at:end], space[at:end]
            edges = np.zeros(end - at + 1, bool)
            lo, hi = np.searchsorted(offsets, [at, end + 1])
            edges[offsets[lo:hi] - at] = True
            edges[0] = edges[-1] = True
            before, after = edges[:-1].copy(), edges[1:].copy()
            before[1:] |= gap[:-1]
            after[:-1] |= gap[1:]
            first = np.flatnonzero(before & ~gap)
            last = np.flatnonzero(after & ~gap) + 1
            total = np.zeros(end - at + 1, U64)
            np.cumsum(self.codes[text] * self.up[: end - at], out=total[1:])
            parts.append(mix((total[last] - total[first]) * self.down[first]))
            starts.append(first + at)
            ends.append(last + at)
        if not parts:
            return np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(parts), np.concatenate(starts), np.concatenate(ends)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one range after another."""
    total = int(lengths.sum())
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - firsts, lengths)


def set_aside(docs, own=("doc_id", "text"), replaced=()):
    """``docs`` with plain names for all columns but ``own``, and what gives the names back.

    So no column of the caller, whatever its name, meets a helper column of an operator or
    has to be quoted. Columns named like those to be ``replaced``, in any case, are left out.
    """
    seen, names, gone = set(), [], []
    for i, name in enumerate(docs.columns):
        if name in own and name not in seen:
            seen.add(name)
            names.append(name)
            continue
        names.append(f"_aside{i}")
        if name.lower() in replaced:
            gone.append(names[-1])
    back = dict(zip(names, docs.columns))

    def restore(df):
        return df.toDF(*[back.get(c, c) for c in df.columns])

    return docs.toDF(*names).drop(*gone), restore


def append_columns(
    docs, make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]], fields: list[T.StructField],
    keep_text: bool = False, slice_bytes: int = 4 * BLOCK_BYTES,
):
    """``docs`` with columns computed from whole texts, a bounded slice of rows at a time.

    ``make`` runs once per task and returns the function from a slice to the new columns.
    Columns of ``docs`` that have a new column's name are replaced; ``text`` itself stays
    only if asked for.
    """
    new = {f.name for f in fields}
    rest = [f for f in docs.schema.fields if f.name not in new and (keep_text or f.name != "text")]
    kept, names = [f.name for f in rest], [*[f.name for f in rest], *[f.name for f in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = make()
        for batch in batches:
            for part in slices(batch, "text", slice_bytes):
                yield pa.record_batch([*[part[c] for c in kept], *columns(part)], names=names)

    needed = dict.fromkeys([*kept, *[c for c in docs.columns if c not in new or c == "text"]])
    return docs.select(*[f"`{c}`" for c in needed]).mapInArrow(run, T.StructType([*rest, *fields]))
