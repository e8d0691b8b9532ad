"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.llm.words import append_columns, raw, set_aside, slices

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
SMOOTHING = 0.5
MAX_LANGUAGES = 512
UNDETERMINED = "und"
FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
_CELLS = 1 << 22  # scores of (n-gram, language) held at once


class _Grams:
    """Hash buckets of the n-grams that end at each character.

    Letters are lower-cased, everything else is one blank; n-grams of blanks alone are
    left out. A text begins after blanks, so no n-gram spans two texts.
    """

    def __init__(self, bits: int):
        chars = [chr(i).lower() for i in range(1 << 16)]
        self.codes = np.array(
            [ord(c) if len(c) == 1 and unicodedata.category(c)[0] == "L" else 0 for c in chars],
            np.uint32,
        )
        self.shift = np.uint32(32 - bits)

    def of(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each order: rows and buckets of its n-grams, rows ascending."""
        data, offsets = raw(column)
        if not len(data):
            return
        heads = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
        begins = heads[offsets]
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        codes = np.where(points < 1 << 16, self.codes[points & 0xFFFF], points)
        rows = np.repeat(np.arange(len(column), dtype=np.int32), np.diff(begins))
        firsts = begins[:-1][np.diff(begins) > 0]
        seconds = begins[:-1][np.diff(begins) > 1] + 1
        back1 = np.empty_like(codes)
        back1[0], back1[1:] = 0, codes[:-1]
        back1[firsts] = 0
        back2 = np.empty_like(codes)
        back2[:1], back2[1:] = 0, back1[:-1]
        back2[firsts] = 0
        back2[seconds] = 0
        keep = (codes != 0) | (back1 != 0)
        rows, codes, back1, back2 = rows[keep], codes[keep], back1[keep], back2[keep]
        key = codes * np.uint32(0x9E3779B1)
        for order, part, factor in ((1, None, 0), (2, back1, 0x85EBCA6B), (3, back2, 0xC2B2AE35)):
            if part is not None:
                key = (key ^ (part * np.uint32(factor))) * np.uint32(0x27D4EB2F)
                key ^= key >> np.uint32(15)
            if order in ORDERS:
                yield rows, ((key + np.uint32(order)) * np.uint32(0x9E3779B1)) >> self.shift


def train(docs: DataFrame, learn: Column, bits: int = BUCKET_BITS) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-probability matrix (buckets + 1) x languages.

    Counts the n-grams of every text whose ``learn`` holds and whose language is known;
    the last row of the matrix holds the log share of documents. Tasks send one count
    per language and bucket, so a hot language costs no more than any other, and the
    driver gets at most languages x buckets sums. More than ``MAX_LANGUAGES`` languages
    are an error. Null texts count as empty.
    """
    buckets = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums = _Grams(bits), {}
        for batch in batches:
            for part in slices(batch, "text"):
                names, which = np.unique(np.array(part["lang"].to_pylist(), object).astype(str),
                                         return_inverse=True)
                for i, name in enumerate(names):
                    own = sums.setdefault(str(name), np.zeros(buckets + 1, np.int64))
                    own[buckets] += int((which == i).sum())
                for rows, found in grams.of(part["text"]):
                    of = which[rows]
                    for i, name in enumerate(names):
                        sums[str(name)][:buckets] += np.bincount(found[of == i], minlength=buckets)
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.record_batch(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at])],
                names=["lang", "bucket", "n"],
            )

    known = docs.where(learn & F.col("lang").isNotNull()).select("text", "lang")
    sums = (
        known.mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    ).toPandas()
    languages = sorted(sums["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; at most {MAX_LANGUAGES} can be told apart")
    counts = np.zeros((buckets + 1, len(languages)))
    counts[sums["bucket"], np.searchsorted(np.array(languages, object), sums["lang"])] = sums["n"]
    if not languages:
        return [], counts
    smooth = counts[:buckets] + SMOOTHING
    table = np.vstack([np.log(smooth / smooth.sum(0)), np.log(counts[buckets] / counts[buckets].sum())])
    return languages, table


def predict(
    docs: DataFrame, languages: list[str], table: np.ndarray, keep_text: bool = False
) -> DataFrame:
    """``docs`` with lang_pred and score for every whole text; ``text`` stays if asked for.

    The score is the posterior probability of the predicted language; equal ones go to
    the first language by name. A text that is null or has no letter is ``und`` with
    score 0, and so is every text where no language was learned. Columns of these names
    are replaced. The matrix is broadcast: (2**16 + 1) x languages numbers.
    """
    bits = (len(table) - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def make():
        grams, weights = _Grams(bits), shared.value
        names, step = pa.array(languages, pa.string()), max(1, _CELLS // len(languages))

        def score(part: pa.RecordBatch) -> list[pa.Array]:
            logs = np.tile(weights[-1], (part.num_rows, 1))
            for rows, found in grams.of(part["text"]):
                for at in range(0, len(rows), step):
                    r = rows[at : at + step]
                    starts = np.flatnonzero(np.diff(r, prepend=-1))
                    logs[r[starts]] += np.add.reduceat(weights[found[at : at + step]], starts)
            odds = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
            return [names.take(pa.array(logs.argmax(1))), pa.array(odds)]

        return score

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    docs, restore = set_aside(docs, replaced={f.name for f in FIELDS})
    marked = docs.withColumn("_letter", has_letter)
    if languages:
        scored = append_columns(marked, make, FIELDS, keep_text)
    else:
        scored = marked if keep_text else marked.drop("text")
        scored = scored.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    return restore(scored.withColumns({
        "lang_pred": F.when(F.col("_letter"), F.col("lang_pred")).otherwise(UNDETERMINED),
        "score": F.when(F.col("_letter"), F.col("score")).otherwise(0.0),
    }).drop("_letter"))
