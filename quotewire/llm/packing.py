"""Packing of tokenised documents: first-fit decreasing in randomised groups."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewire.llm.words import U64, WordHasher, mix, ranges, raw, slices
from quotewire.session import materialize, text_batches

LENGTH = 4096
END_ID = 2
#: Pieces per group, about; a group is packed in one task.
GROUP_PIECES = 4096
#: Distinct words whose ids a task keeps.
CACHE_WORDS = 300_000
#: Distinct parts of words whose ids a task keeps; a part costs several times a word.
CACHE_PARTS = 100_000
#: Bytes of texts that are encoded at once; the arrays made of them are some 30 times that.
SLICE_BYTES = 1 << 20


class _Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class _Lists:
    """Numbered lists of token ids, stored end to end."""

    def __init__(self):
        self.flat, self.lengths = np.empty(0, np.uint32), np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)

    def append(self, flat, lengths) -> None:
        self.flat = np.concatenate([self.flat, np.asarray(flat, np.uint32)])
        self.lengths = np.concatenate([self.lengths, np.asarray(lengths, np.int32)])
        self.starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[which].astype(np.int64)
        return self.flat[ranges(self.starts[which], lengths)], lengths


class _WordIds:
    """Token ids of texts, from the ids of their distinct words and of those words' parts.

    For tokenizers that drop white space and let no token cross it, which holds for BPE
    over words: a text's ids are those of its words in turn. Words are told apart by their
    64-bit hashes. New words are normalised together, parted by the tokenizer's own
    pattern, and its model encodes each distinct part once. Words with characters that
    could interact with a neighbour or with part of a special token, and all words under a
    pre-tokenizer that is not one pattern over bytes, are encoded singly by the whole
    tokenizer.
    """

    #: Visible characters below U+0300: white space, controls, combining marks, the one
    #: letter that is longer in lower case, and the bracket of special tokens are left out.
    PLAIN = re.compile("[!-;=-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u02ff]+")

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.hasher = Tokenizer.from_str(definition), WordHasher(SLICE_BYTES >> 2)
        self.pattern = self._pattern(self._steps(self.tokenizer.pre_tokenizer))
        self.normal = self._normal(self._steps(self.tokenizer.normalizer), self.tokenizer.normalizer)
        shown = [i for i in range(256) if chr(i).isprintable() and chr(i) != " "]
        hidden = [i for i in range(256) if i not in shown]
        # Byte-level BPE writes a byte as itself where it can be seen, else from U+0100 on.
        self.letters = {b: 256 + i for i, b in enumerate(hidden)}
        self._forget_words(np.empty(0, np.int64))
        self._forget_parts()

    @staticmethod
    def _steps(part) -> dict:
        """The definition of a part of the tokenizer, without that of its vocabulary."""
        return {} if part is None else json.loads(part.__getstate__())

    @staticmethod
    def _pattern(steps: dict) -> regex.Pattern | None:
        steps = steps.get("pretokenizers", [])
        if [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            return None
        cut, level = steps
        if "Regex" not in cut["pattern"] or cut["behavior"] != "Removed" or not cut["invert"]:
            return None
        if level["add_prefix_space"] or level["use_regex"]:
            return None
        import regex

        return regex.compile(" |" + cut["pattern"]["Regex"])

    @staticmethod
    def _normal(steps: dict, normalizer) -> Callable[[str], str]:
        """How plain words, joined by blanks, are normalised."""
        kinds = [s["type"] for s in steps.get("normalizers", [steps] if steps else [])]
        blanks = [s for s in steps.get("normalizers", [steps]) if s.get("type") == "Replace"]
        only = all(s["pattern"] == {"Regex": "\\s+"} and s["content"] == " " for s in blanks)
        if not only or not set(kinds) <= {"NFC", "Replace", "Lowercase"}:
            return normalizer.normalize_str
        # Plain characters are composed as they are, and single blanks stay.
        return str.lower if "Lowercase" in kinds else str

    def _forget_words(self, kept: np.ndarray) -> None:
        """Drop all words but those at these places in order of their hashes."""
        if len(kept):
            flat, lengths = self.ids.take(self.number[kept])
            self.hashes = self.hashes[kept]
        else:
            flat, lengths, self.hashes = [], [], np.empty(0, U64)
        self.ids = _Lists()
        self.ids.append(flat, lengths)
        self.number = np.arange(len(self.hashes))
        self.again = np.zeros(len(self.hashes), bool)

    def _forget_parts(self) -> None:
        self.parts, self.ids_of_part = _Numbered(), _Lists()
        self.parts[" "]
        self.ids_of_part.append([], [0])

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words in order, and each word's number of ids."""
        if len(self.parts) > CACHE_PARTS:
            self._forget_parts()
        texts = b" ".join(new).decode().split(" ")
        plain = [i for i, t in enumerate(texts) if self.PLAIN.fullmatch(t)] if self.pattern else []
        joined = " ".join([texts[i] for i in plain])
        normal = self.normal(joined) if plain else ""
        if normal.count(" ") != len(plain) - 1:
            plain, normal = [], ""
        known, number = len(self.parts), self.parts.__getitem__
        found = self.pattern.findall(normal) if plain else []
        part = np.fromiter(map(number, found), np.int64, len(found))
        word = np.array(plain, np.int64)[np.cumsum(part == 0)[part > 0]] if plain else part
        part = part[part > 0]
        tokenize, letters = self.tokenizer.model.tokenize, self.letters
        lists = [
            [t.id for t in tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(letters))]
            for p in islice(self.parts, known, None)
        ]
        odd = sorted(set(range(len(texts))) - set(plain))
        whole = []
        for i in odd:  # a key of its own, as no part of a word is a tuple
            if (texts[i],) not in self.parts:
                lists.append(self.tokenizer.encode(texts[i], add_special_tokens=False).ids)
            whole.append(number((texts[i],)))
        word = np.append(word, np.array(odd, np.int64))
        part = np.append(part, np.array(whole, np.int64))
        order = np.argsort(word, kind="stable")
        self.ids_of_part.append(list(chain.from_iterable(lists)), [len(own) for own in lists])
        flat, lengths = self.ids_of_part.take(part[order])
        n_ids = np.bincount(word[order], weights=lengths, minlength=len(texts)).astype(np.int64)
        return flat, n_ids

    def encode(self, texts: pa.Array | list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and each text's number of ids."""
        if len(self.hashes) > CACHE_WORDS:  # words met again are likely to come once more
            kept = np.flatnonzero(self.again)
            self._forget_words(kept[: CACHE_WORDS // 2])
        data, offsets = raw(pa.array(texts, pa.binary()) if isinstance(texts, list) else texts)
        hashes, starts, ends = self.hasher.spans(data, offsets)
        met, first, index = np.unique(hashes, return_index=True, return_inverse=True)
        spot = np.searchsorted(self.hashes, met)
        old = np.zeros(len(met), bool)
        inside = spot < len(self.hashes)
        old[inside] = self.hashes[spot[inside]] == met[inside]
        self.again[spot[old]] = True
        if not old.all():
            text, at = data.tobytes(), first[~old]
            new = [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            numbers = np.arange(len(self.hashes), len(self.hashes) + len(new))
            self.ids.append(*self._learn(new))
            place = spot[~old]
            self.hashes = np.insert(self.hashes, place, met[~old])
            self.number = np.insert(self.number, place, numbers)
            self.again = np.insert(self.again, place, False)
            spot = np.searchsorted(self.hashes, met)
        ids, n_ids = self.ids.take(self.number[spot][index])
        of_word = np.append(0, np.cumsum(n_ids))
        return ids, np.diff(of_word[np.searchsorted(starts, offsets)])


def pieces(
    docs: DataFrame, definition: str, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, _spot): documents cut to fit.

    A document's ids are its text's and then ``end_id``; a null text is empty. It is cut
    into pieces of ``length`` ids and a last one. ``_spot`` is a random number that depends
    on the document's id, its row's place in the task and ``start``, so rows that repeat an
    id are spread too; how a table is stored thus decides which documents share a sequence.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, met = _WordIds(shared.value), 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, counts = encoder.encode(part["text"])
                sizes = counts + 1
                ends = np.cumsum(sizes)
                flat = np.full(int(ends[-1]), end_id, "<u4")
                inside = np.ones(len(flat), bool)
                inside[ends - 1] = False
                flat[inside] = ids
                n_pieces = -(-sizes // length)
                row = np.repeat(np.arange(len(sizes)), n_pieces)
                start = ranges(np.zeros(len(sizes), np.int64), n_pieces) * length
                size = np.minimum(length, sizes[row] - start)
                first = 4 * ((ends - sizes)[row] + start)
                data = memoryview(flat).cast("B")
                code = [zlib.crc32(data[a:b]) for a, b in zip(first.tolist(), (first + 4 * size).tolist())]
                keys = part["_key"].to_numpy().view(np.uint64)
                again = np.arange(met, met + part.num_rows).astype(np.uint64)
                met += part.num_rows
                spots = mix(keys + mix(again))[row]
                spots = mix(spots + start.astype(np.uint64)).view(np.int64)
                yield pa.record_batch(
                    [
                        part["doc_id"].take(pa.array(row)), pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()), pa.array(code, pa.int64()),
                        pa.array(sizes[row], pa.int64()), pa.array(spots),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_spot"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("doc_id").alias("_key"), "text").mapInArrow(
        run,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, _spot long",
    )


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size, taken in order of falling size; the first bin with room gets it.

    A tournament tree holds the room left in the fullest-first row of bins: every inner
    node knows the most room below it, so the first bin that fits is found on one way down.
    """
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room, out = [capacity] * (2 * leaves), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size, node = sizes[i], 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        out[i] = node - leaves
        room[node] -= size
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return out


def pack(
    docs: DataFrame, definition: str, length: int = LENGTH, end_id: int = END_ID,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one a piece.

    ``definition`` is the text of a tokenizers file. Documents are cut only where they are longer than a sequence. Groups of about
    ``group_pieces`` random pieces are packed independently, so work and memory of a task do
    not grow with the table, and a document that is repeated is spread over groups. Null,
    empty and word-less texts are one piece that holds ``end_id`` alone. Other columns are
    dropped. sequence_id is group x 2**32 + number in the group; offset counts from 0.
    """
    with text_batches(docs.sparkSession):
        cut = materialize(pieces(docs, definition, length, end_id))
    groups = max(1, -(-cut.count() // group_pieces))
    group = F.pmod("_spot", F.lit(groups)).alias("_group")

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "_spot", "start"], ascending=[False, True, True])
        number = np.array(first_fit_decreasing(frame["length"].tolist(), length), np.int64)
        frame = frame.assign(sequence_id=frame["_group"] * (1 << 32) + number)
        offset = frame.groupby("sequence_id")["length"].cumsum() - frame["length"]
        return frame.assign(offset=offset).drop(columns=["_spot", "_group"])

    kind = cut.schema["doc_id"].dataType.simpleString()
    return cut.select("*", group).groupBy("_group").applyInPandas(
        fill,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long",
    )
