"""Sampled segmentation into the pieces of a SentencePiece model, and lossless decoding.

All ways to cut a word into pieces form a lattice. Forward filtering sums the weights of
all ways to reach each place; backward sampling then draws pieces from the end, each with
its share of what leads there, so a whole segmentation comes out with its exact
probability. Draws are hashes of the row's key and the place, so a row always gets the
same segmentation, wherever and however often it is computed.

Lattices of distinct words are filtered once; the sampling runs through all words of many
texts at a time. A long run without blanks is parted where no piece reaches across: all
ways pass there, so its parts are independent and the run's probabilities are exact.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.llm.packing import _Numbered
from quotewire.llm.words import U64, append_columns, mix, ranges, set_aside

SPACE = "▁"
#: How sharply samples prefer likely pieces; 1 samples by the pieces' own probabilities.
SHARPNESS = 1.0
#: Distinct words whose lattices a task keeps.
CACHE_WORDS = 100_000
#: Bytes of a word, leading blanks included, up to which a task keeps its lattice.
MAX_WORD = 96
#: Bytes of longer words that are filtered at once; a single lattice may be longer.
RUN_BYTES = 1 << 18
#: From so few long words on, places are filtered one by one.
FEW_WORDS = 8
_BASE = 0x9E3779B97F4A7C15
_MOST = 2**32 - 1
_TOP_BITS = 18


def read_model(path: str) -> list[tuple[bytes, int]]:
    """Bytes and kind (0 piece, 1 single byte, 2 control) of all pieces, in order of rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            out.append((bytes([int(name[1:-1], 16)]), 1))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            out.append((name.encode(), 2))
        else:
            out.append((name.replace(SPACE, " ").encode(), 0))
    return out


class _Lattices:
    """Filtered lattices of distinct words, as one table of edges.

    Every place of a word is a node; its edges are the pieces that end there, with the
    running shares, in 32 bits, of the ways that use them. A piece of rank r weighs 1 / (r + 2), the
    usual fall of frequencies with rank; a single byte weighs 1 / (n + 2)**2, less than
    any of the n pieces, so bytes serve where nothing fits and otherwise by rare chance.
    """

    def __init__(self, pieces: Sequence[tuple[bytes, int]], sharpness: float):
        n, rank, known = len(pieces), 0, {}
        self.bytes = np.full(256, -1)
        for number, (name, kind) in enumerate(pieces):
            if kind == 1:
                self.bytes[name[0]] = number
            elif kind == 0 and name not in known:
                known[name] = (number, -sharpness * np.log(rank + 2))
                rank += 1
        if (self.bytes < 0).any():
            raise ValueError("the model cannot fall back to bytes")
        self.low = -2 * sharpness * np.log(n + 2)
        self.longest = max(map(len, known), default=1)
        starts = {name[:i] for name in known for i in range(1, len(name) + 1)}
        names = sorted(starts)
        hashed = self._hash(b"".join(names), np.cumsum([0, *map(len, names)]))
        order = np.argsort(hashed)
        # One entry more, above all keys, and the first entry of each value of the top bits.
        self.prefix = np.append(hashed[order], U64(2**64 - 1))
        self.number = np.array([*[known.get(names[i], (-1, 0.0))[0] for i in order], -1])
        self.weight = np.array([*[known.get(names[i], (-1, 0.0))[1] for i in order], 0.0])
        tops = np.arange(1 << _TOP_BITS).astype(U64) << U64(64 - _TOP_BITS)
        self.top = np.searchsorted(self.prefix, tops)
        self.clear()

    @staticmethod
    def _sums(data: bytes) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer(data, np.uint8).astype(U64) + U64(0x632BE59BD9B4E019)
        up, down = (np.full(len(codes) + 1, b, U64) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        total = np.zeros(len(codes) + 1, U64)
        np.cumsum(mix(codes) * np.multiply.accumulate(up)[:-1], out=total[1:])
        return total, np.multiply.accumulate(down)

    @classmethod
    def _hash(cls, data: bytes, offsets: np.ndarray) -> np.ndarray:
        total, down = cls._sums(data)
        return mix((total[offsets[1:]] - total[offsets[:-1]]) * down[offsets[:-1]])

    def clear(self) -> None:
        self.words = _Numbered()
        self.again, self.length, self.first = np.empty(0, bool), np.empty(0, np.int64), np.empty(0, np.int64)
        self.edge, self.share = np.empty(0, np.int64), np.empty(0, np.uint32)
        self.piece, self.back = np.empty(0, np.int32), np.empty(0, np.int32)

    def tables(self) -> tuple[np.ndarray, ...]:
        """All that is known of the words so far; :meth:`learn` makes new tables."""
        return self.again, self.length, self.first, self.edge, self.share, self.piece, self.back

    def forget(self, tables: tuple[np.ndarray, ...]) -> None:
        """Drop the words learnt since these were the tables."""
        self.again, self.length, self.first, self.edge, self.share, self.piece, self.back = tables
        while len(self.words) > len(self.length):
            self.words.popitem()

    def keep_common(self, most: int) -> None:
        """Keep the words that were met again after they were learnt, the first ``most``."""
        kept = np.flatnonzero(self.again)[:most]
        names, length, first = list(self.words), self.length[kept], self.first[kept]
        nodes = ranges(first, length)
        n_edges = np.diff(np.append(self.edge, len(self.share)))[nodes]
        edges = ranges(self.edge[nodes], n_edges)
        self.words = _Numbered(zip([names[i] for i in kept.tolist()], range(len(kept))))
        self.again, self.length, self.first = np.zeros(len(kept), bool), length, np.cumsum(length) - length
        self.edge, self.share = np.cumsum(n_edges) - n_edges, self.share[edges]
        self.piece, self.back = self.piece[edges], self.back[edges]

    def _found(self, at, word_end, total, down):
        """Places (start, end) and spots of all pieces that start ``at`` and end in the word."""
        size = 0
        while len(at):
            size += 1
            at = at[at + size <= word_end[at]]
            key = mix((total[at + size] - total[at]) * down[at])
            spot = self.top[key >> U64(64 - _TOP_BITS)]
            late = np.flatnonzero(self.prefix[spot] < key)
            while len(late):
                spot[late] += 1
                late = late[self.prefix[spot[late]] < key[late]]
            hit = self.prefix[spot] == key
            at, spot = at[hit], spot[hit]
            whole = self.number[spot] >= 0
            yield at[whole], at[whole] + size, spot[whole]

    def parts(self, runs: list[bytes]) -> list[list[bytes]]:
        """Each run, cut at all places that no piece reaches across."""
        data, lengths = b"".join(runs), np.array([len(r) for r in runs])
        total, down = self._sums(data)
        offsets = np.append(0, np.cumsum(lengths))
        word_end = np.repeat(offsets[1:], lengths)
        change = np.zeros(len(data) + 1, np.int32)
        for at in range(0, len(data), RUN_BYTES):
            starts = np.arange(at, min(at + RUN_BYTES, len(data)))
            for start, end, _ in self._found(starts, word_end, total, down):
                # No place twice in either, as all these pieces are of one length.
                change[start + 1] += 1
                change[end] -= 1
        cuts = np.flatnonzero(np.cumsum(change) == 0)
        first = np.searchsorted(cuts, offsets)
        cuts = cuts.tolist()
        return [
            [data[a:b] for a, b in zip(cuts[i:j], cuts[i + 1 : j + 1])] for i, j in zip(first, first[1:])
        ]

    def learn(self, new: list[bytes]) -> None:
        """Filter the lattices of new words, all places that are equally far along at once."""
        data, lengths = b"".join(new), np.array([len(w) for w in new])
        total, down = self._sums(data)
        offsets = np.append(0, np.cumsum(lengths))
        word_end = np.repeat(offsets[1:], lengths)
        at = np.arange(len(data))
        starts, ends = [at], [at + 1]
        pieces = [self.bytes[np.frombuffer(data, np.uint8)]]
        weights = [np.full(len(at), self.low)]
        for first, last, spot in self._found(at, word_end, total, down):
            starts.append(first)
            ends.append(last)
            pieces.append(self.number[spot])
            weights.append(self.weight[spot])
        start, end, piece, weight = (np.concatenate(x) for x in (starts, ends, pieces, weights))
        # Node i of the data is the place after byte i; edges in the order of their nodes.
        order = np.argsort(end, kind="stable")
        start, end, piece, weight = start[order], end[order], piece[order], weight[order]
        head = np.repeat(offsets[:-1], lengths)[end - 1]
        along = end - head
        share = np.empty(len(end))
        by_step = np.argsort(along, kind="stable")
        cuts = np.append(0, np.cumsum(np.bincount(along)))
        after = np.zeros(len(data) + 1)  # weight of all ways from the word's start
        by_length = np.sort(lengths)
        for step in range(1, len(cuts) - 1):
            if step > MAX_WORD and len(new) - np.searchsorted(by_length, step) <= FEW_WORDS:
                for i in np.flatnonzero(lengths >= step):
                    self._walk(int(offsets[i]), step, int(offsets[i + 1]), start, end, weight, after, share)
                break
            some = by_step[cuts[step] : cuts[step + 1]]
            if not len(some):
                continue
            inner = start[some] > head[some]
            score = weight[some] + np.where(inner, after[start[some]], 0.0)
            node = end[some]
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            count = np.diff(np.append(first, len(some)))
            top = np.maximum.reduceat(score, first)
            part = np.exp(score - np.repeat(top, count))
            whole = np.add.reduceat(part, first)
            after[node[first]] = top + np.log(whole)
            run = np.cumsum(part / np.repeat(whole, count))
            before = np.append(0.0, run[first[1:] - 1])
            share[some] = run - np.repeat(before, count)
            share[some[first + count - 1]] = 1.0
        base = int(self.length.sum())
        self.first = np.append(self.first, base + offsets[:-1])
        self.length = np.append(self.length, lengths)
        self.again = np.append(self.again, np.zeros(len(new), bool))
        n_edges = np.bincount(end - 1, minlength=len(data))
        self.edge = np.append(self.edge, len(self.share) + np.cumsum(n_edges) - n_edges)
        self.share = np.append(self.share, np.minimum(np.rint(share * 2.0**32), _MOST).astype(np.uint32))
        self.piece = np.append(self.piece, piece.astype(np.int32))
        self.back = np.append(self.back, (end - start).astype(np.int32))

    def _walk(self, head, step, last, start, end, weight, after, share) -> None:
        """Filter one word's places from ``step`` on, one after another."""
        for low in range(head + step, last + 1, 1 << 14):
            high = min(low + (1 << 14), last + 1)
            a, b = np.searchsorted(end, [low, high])
            origin = max(head, low - self.longest)
            known = after[origin:low].tolist()
            if origin == head:
                known[0] = 0.0
            froms, scores = (start[a:b] - origin).tolist(), weight[a:b].tolist()
            shares, i = [], 0
            for n in np.bincount(end[a:b] - low).tolist():
                own = [scores[j] + known[froms[j]] for j in range(i, i + n)]
                top = max(own)
                ways = [math.exp(x - top) for x in own]
                whole, run = math.fsum(ways), 0.0
                for x in ways:
                    run += x / whole
                    shares.append(run)
                shares[-1] = 1.0
                known.append(top + math.log(whole))
                i += n
            share[a:b] = shares
            after[low:high] = known[low - origin :]

    def sample(self, word: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all words in order, and each word's number of pieces."""
        place, who, step = self.length[word].copy(), np.arange(len(word)), 0
        found = []
        while len(who):
            draw = mix(key[who] + U64(step * _BASE % (1 << 64))) >> U64(32)
            draw = np.minimum(draw, U64(_MOST - 1)).astype(np.uint32)  # below a node's last share
            edge = self.edge[self.first[word[who]] + place[who] - 1]
            late = np.flatnonzero(self.share[edge] <= draw)
            while len(late):
                edge[late] += 1
                late = late[self.share[edge[late]] <= draw[late]]
            found.append((who, self.piece[edge]))
            place[who] -= self.back[edge]
            who = who[place[who] > 0]
            step += 1
        counts = np.zeros(len(word), np.int64)
        for who, _ in found:
            counts[who] += 1
        last = np.cumsum(counts) - 1
        out = np.empty(int(counts.sum()), np.int32)
        for step, (who, piece) in enumerate(found):
            out[last[who] - step] = piece
        return out, counts


def _groups(words: list[bytes], most: int) -> Iterator[list[bytes]]:
    """The words in turn, in lists of at most so many bytes, or one word."""
    group, size = [], 0
    for word in words:
        if group and size + len(word) > most:
            yield group
            group, size = [], 0
        group.append(word)
        size += len(word)
    yield group


def _runs(text: bytes, cut: Callable[[bytes], list[bytes]]) -> list[bytes]:
    """Runs of a text with a blank in front: words with the blanks before them, line ends, blanks."""
    text = b" " + text
    if b"  " in text:
        return cut(text)
    out: list[bytes] = []
    for n, line in enumerate(text.split(b"\n")):
        if n:
            out.append(b"\n")
        head, *rest = line.split(b" ")
        if head:
            out.append(head)
        out += [b" " + word for word in rest]
    return out


class _Decoder:
    """Texts of lists of ids, which lie end to end."""

    def __init__(self, pieces: Sequence[tuple[bytes, int]]):
        names = [name if kind != 2 else b"" for name, kind in pieces]
        self.lengths = np.array([len(n) for n in names])
        self.starts, self.flat = np.cumsum(self.lengths) - self.lengths, np.frombuffer(b"".join(names), np.uint8)

    def texts(self, ids: np.ndarray, counts: np.ndarray, valid: np.ndarray) -> pa.Array:
        lengths = self.lengths[ids]
        data = self.flat[ranges(self.starts[ids], lengths)].tobytes()
        ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(counts))]
        return pa.array([
            data[a + 1 : b].decode("utf-8") if known else None for a, b, known in zip(ends, ends[1:], valid)
        ], pa.string())


def encode(
    docs: DataFrame, pieces: Sequence[tuple[bytes, int]], key: str = "doc_id", seed: int = 0,
    sharpness: float = SHARPNESS, keep_text: bool = False, with_decoded: bool = False,
) -> DataFrame:
    """``docs`` with ``ids``: one sampled segmentation of each whole text.

    A text starts with one blank more, as the model's own encoder has it. The draws depend
    on the row's ``key``, the seed, the place and the text only; equal rows get equal ids.
    Runs without blanks or line ends are sampled from the lattice of the whole run, however
    long; no piece of the model may cross from one to the next. A null text has no ids, like
    no other; an empty one has the blank's. A column ``ids`` is replaced. ``with_decoded``
    adds what :func:`decode` would, from the ids, in the same pass over the rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(list(pieces))
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if with_decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    docs, restore = set_aside(docs, own=("text", key), replaced={f.name for f in fields})
    keyed = docs.withColumn("_key", F.xxhash64(F.lit(seed), F.col(key)))

    def make():
        lattices, decoder = _Lattices(shared.value, sharpness), _Decoder(shared.value)
        cut = re.compile(rb" *[^ \n]+|\n| +").findall

        def ids(part: pa.RecordBatch) -> list[pa.Array]:
            if len(lattices.words) > CACHE_WORDS:
                lattices.keep_common(CACHE_WORDS // 2)
            texts = part["text"].cast(pa.binary()).to_pylist()
            words = [_runs(t, cut) if t is not None else [] for t in texts]
            known, number = len(lattices.words), lattices.words.__getitem__
            long = [max(map(len, own), default=0) > MAX_WORD for own in words]
            if any(long):
                runs = {w: (w,) for own, some in zip(words, long) if some for w in own}
                longer = [w for w in runs if len(w) > MAX_WORD]
                runs.update(zip(longer, lattices.parts(longer)))
                words = [
                    list(chain.from_iterable(map(runs.__getitem__, own))) if some else own
                    for own, some in zip(words, long)
                ]
                for word in chain.from_iterable(words):
                    if len(word) <= MAX_WORD:
                        number(word)
            kept = None
            n_words = np.array([len(own) for own in words], np.int64)
            index = np.fromiter(map(number, chain.from_iterable(words)), np.int64, int(n_words.sum()))
            lattices.again[index[index < known]] = True
            if len(lattices.words) > known:
                new = list(lattices.words)[known:]
                short = sum(len(w) <= MAX_WORD for w in new)  # these come first
                if short:
                    lattices.learn(new[:short])
                if short < len(new):
                    kept = lattices.tables()
                    for group in _groups(new[short:], RUN_BYTES):
                        lattices.learn(group)
            keys = part["_key"].to_numpy().view(U64)
            place = ranges(np.zeros(len(texts), np.int64), n_words).astype(U64)
            key = mix(np.repeat(keys, n_words) + place * U64(0xD6E8FEB86659FD93))
            found, counts = lattices.sample(index, key)
            if kept:
                lattices.forget(kept)
            of_word = np.append(0, np.cumsum(counts))
            offsets = of_word[np.append(0, np.cumsum(n_words))]
            nulls = np.append(np.asarray(part["text"].is_null()), False)
            texts = [decoder.texts(found, np.diff(offsets), ~nulls[:-1])] if with_decoded else []
            offsets = pa.array(offsets, pa.int32(), mask=nulls)
            return [pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())), *texts]

        return ids

    return restore(append_columns(keyed, make, fields, keep_text, slice_bytes=1 << 20).drop("_key"))


def decode(rows: DataFrame, pieces: Sequence[tuple[bytes, int]], ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the text of each list of ids; null for null.

    Undoes :func:`encode` exactly. Control pieces stand for nothing.
    """
    shared = rows.sparkSession.sparkContext.broadcast(list(pieces))
    rows, restore = set_aside(rows, own=(ids,), replaced={"decoded"})
    kept = rows.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _Decoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part[ids]
                counts = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0))
                texts = decoder.texts(lists.flatten().to_numpy(), counts, np.asarray(lists.is_valid()))
                columns = [part[f.name] for f in kept]
                yield pa.record_batch([*columns, texts], names=[*[f.name for f in kept], "decoded"])

    schema = T.StructType([*kept, T.StructField("decoded", T.StringType())])
    return restore(rows.select(*[f.name for f in kept]).mapInArrow(run, schema))
