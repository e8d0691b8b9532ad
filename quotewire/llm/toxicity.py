"""Toxicity scores by a logistic model that swapping identity terms should not change.

A text is the set of its words, hashed. The fit minimises the log-loss of labelled texts,
an L1 penalty that leaves most words without a say, and the mean square change of the
score (before the logistic) when an identity term of a labelled text is swapped for others
of its kind. A neutral mention of a group so gains no weight of its own, though toxic
texts may name the group more often.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.llm.samples import bounded_sample, labelled, one_text_per_key
from quotewire.llm.words import U64, WordHasher, append_columns, set_aside, slices
from quotewire.session import materialize

# Identity terms that stand for one another, by kind.
IDENTITY_TERMS: Mapping[str, Sequence[str]] = {
    "gender": ("woman", "man", "female", "male", "transgender", "nonbinary"),
    "genders": ("women", "men", "girls", "boys", "females", "males"),
    "religion": ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    "religions": ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    "origin": ("african", "american", "arab", "asian", "chinese", "european", "indian", "mexican"),
    "origins": ("africans", "americans", "arabs", "asians", "europeans", "indians", "mexicans"),
    "colour": ("black", "white", "brown", "latino", "hispanic"),
    "orientation": ("gay", "lesbian", "bisexual", "queer", "straight", "heterosexual"),
    "ability": ("blind", "deaf", "disabled", "autistic"),
    "age": ("young", "old", "elderly", "teenage"),
}

BITS = 20
#: Labelled texts a model is fitted on, about; half of each label where there are enough.
MAX_TEXTS = 12_000
PENALTY = 3.0
REFIT = 0.1
CHANGE_PENALTY = 1.0
STEPS = 400
ROUNDS = 8
FIELDS = [T.StructField("score", T.DoubleType())]


def _hasher() -> WordHasher:
    return WordHasher(letters=True)


def _buckets(words: np.ndarray) -> np.ndarray:
    return (words >> U64(64 - BITS)).astype(np.int32)


def features(texts: DataFrame) -> DataFrame:
    """Rows (label, words): the distinct word buckets of each text, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for batch in batches:
            for part in slices(batch, "text"):
                words, heads = hasher.words(part["text"])
                found = _buckets(words)
                sets = [np.unique(found[a:b]) for a, b in zip(heads, heads[1:])]
                yield pa.record_batch(
                    [part["label"], pa.array([s.astype("<i4").tobytes() for s in sets], pa.binary())],
                    names=["label", "words"],
                )

    return texts.select("label", "text").mapInArrow(run, "label int, words binary")


def swaps(sets: list[np.ndarray], terms: Mapping[str, Sequence[str]]):
    """Sparse rows (row, column, value): what each swap of a term takes from and adds to a text."""
    rows, columns, values, n = [], [], [], 0
    for kind in terms.values():
        hashed, _ = _hasher().words(pa.array(list(kind), pa.string()))
        own = _buckets(hashed)
        for words in sets:
            for i in np.flatnonzero(np.isin(own, words)):
                for j in range(len(own)):
                    if own[j] == own[i]:
                        continue
                    rows += [n, n] if own[j] not in words else [n]
                    columns += [own[i], own[j]] if own[j] not in words else [own[i]]
                    values += [1.0, -1.0] if own[j] not in words else [1.0]
                    n += 1
    return np.array(rows, np.int64), np.array(columns, np.int64), np.array(values), n


def fit(
    sets: list[np.ndarray], labels: np.ndarray, weights: np.ndarray,
    terms: Mapping[str, Sequence[str]] = IDENTITY_TERMS,
    penalty: float = PENALTY, refit: float = REFIT, change_penalty: float = CHANGE_PENALTY,
) -> tuple[np.ndarray, float]:
    """Weights of all word buckets and the bias.

    ``weights`` are those of the texts, so that a sample stands for its whole; ``penalty``
    counts texts, of the rarer label, that a word must explain to have a say, whatever
    share of its label the sample holds. The words that do are then
    fitted again under the smaller penalty ``refit``, so that they get their full weight.
    Both fits take proximal gradient steps over the words that violate optimality, and
    end when no other word does.
    """
    names, columns = np.unique(np.concatenate([*sets, np.empty(0, np.int32)]), return_inverse=True)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    change_rows, change_names, change, n_changes = swaps(sets, terms)
    at = np.searchsorted(names, change_names)
    held = (at < len(names)) & (np.append(names, -1)[at] == change_names)
    change_rows, at, change = change_rows[held], at[held], change[held]
    weights = weights / weights.sum()
    share = float((weights * labels).sum())
    w, bias = np.zeros(len(names)), float(np.log(share / (1 - share)))
    rarer = labels == (share <= 0.5)
    floor = weights[rarer].mean()

    def error(real, bias):
        margin = np.bincount(rows, real[columns], minlength=len(sets)) + bias
        return weights * (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - labels)

    def slopes(w, bias):
        g = np.bincount(columns, error(w, bias)[rows], minlength=len(names))
        if n_changes:
            delta = np.bincount(change_rows, change * w[at], minlength=n_changes)
            g += np.bincount(at, change * delta[change_rows], minlength=len(names)) * (
                2 * change_penalty / n_changes
            )
        return g

    active = np.zeros(len(names), bool)
    for _ in range(ROUNDS):
        wrong = (np.abs(slopes(w, bias)) > penalty * floor * 1.05) & ~active
        if not wrong.any():
            break
        active |= wrong
        w, bias = _steps(sets, names, columns, rows, at, change_rows, change, n_changes, active,
                         labels, weights, w, bias, penalty * floor, change_penalty)
        active = w != 0
    w, bias = _steps(sets, names, columns, rows, at, change_rows, change, n_changes, active,
                     labels, weights, w, bias, refit * floor, change_penalty)
    table = np.zeros(1 << BITS, np.float32)
    table[names] = w
    return table, bias


def _steps(sets, names, columns, rows, at, change_rows, change, n_changes, active,
           labels, weights, w, bias, penalty, change_penalty):
    """Accelerated proximal gradient steps on the ``active`` words and the bias."""
    own = np.flatnonzero(active)
    place = np.full(len(names), -1)
    place[own] = np.arange(len(own))
    some = active[columns]
    rows, columns = rows[some], place[columns[some]]
    some = active[at]
    change_rows, at, change = change_rows[some], place[at[some]], change[some]
    touched, rows = np.unique(rows, return_inverse=True)  # texts without an active word are alike
    rest = np.ones(len(sets), bool)
    rest[touched] = False
    mass, toxic = weights[rest].sum(), (weights * labels)[rest].sum()
    weights, labels = weights[touched], labels[touched]
    # Words' scales even out how often they occur, so that rare ones move as fast.
    scale = 1 / np.sqrt(np.bincount(columns, weights[rows], minlength=len(own)) + 1e-9)

    def spread(real):
        out = np.bincount(rows, real[columns], minlength=len(touched))
        return out, np.bincount(change_rows, change * real[at], minlength=n_changes)

    def gather(error, delta):
        g = np.bincount(columns, error[rows], minlength=len(own))
        if n_changes:
            g = g + np.bincount(at, change * delta[change_rows], minlength=len(own)) * (
                2 * change_penalty / n_changes
            )
        return g * scale

    def logistic(m):
        return 1 / (1 + np.exp(-np.clip(m, -60, 60)))

    v, b = np.ones(len(own)), 1.0
    for _ in range(15):  # power iteration on the bound of the second derivative
        size = np.sqrt((v * v).sum() + b * b)
        v, b = v / size, b / size
        margin, delta = spread(v * scale)
        m = 0.25 * weights * (margin + b)
        v, b = gather(m, delta), m.sum() + 0.25 * mass * b
    step = 1 / (1.2 * np.sqrt((v * v).sum() + b * b) + 1e-12)
    x = w[own] / scale
    ahead, ahead_bias, t = x, bias, 1.0
    for _ in range(STEPS):
        margin, delta = spread(ahead * scale)
        error = weights * (logistic(margin + ahead_bias) - labels)
        slope = error.sum() + mass * logistic(ahead_bias) - toxic
        new = ahead - step * gather(error, delta)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty * scale, 0)
        new_bias = ahead_bias - step * slope
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - x)
        ahead_bias = new_bias + (t - 1) / t_new * (new_bias - bias)
        still = np.abs(new - x).max(initial=0) < 1e-7 and abs(new_bias - bias) < 1e-7
        x, bias, t = new, new_bias, t_new
        if still:
            break
    out = np.zeros(len(names))
    out[own] = x * scale
    return out, float(bias)


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, most: int = MAX_TEXTS,
    terms: Mapping[str, Sequence[str]] = IDENTITY_TERMS,
) -> tuple[np.ndarray, float]:
    """The model of the texts of ``docs`` whose ``learn`` holds and whose toxic label is known.

    The driver gets the word sets of about ``most`` texts, whatever the input; of rows that
    repeat a doc_id one text is learned from. ``terms`` are the groups of identity terms
    whose members are swapped; texts that hold none are learned from without swaps. Without
    texts of both labels the model is the share of toxic ones (0 if there is none).
    """
    known = labelled(labels, "toxic").withColumnRenamed("toxic", "label")
    rows = docs.where(learn & F.col("text").isNotNull()).select("doc_id", "text")
    keys = materialize(rows.select("doc_id").distinct().join(known, "doc_id"))
    sizes = {r["label"]: r["n"] for r in keys.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # The sample is bounded, so it can go to the texts instead of the texts to it.
    chosen = F.broadcast(bounded_sample(keys, most, "label"))
    sample = features(one_text_per_key(rows.join(chosen, "doc_id"))).toArrow()
    label = sample["label"].to_numpy().astype(float)
    if len(np.unique(label)) < 2:
        share = float(label.mean()) if len(label) else 0.0
        return np.zeros(1 << BITS, np.float32), 30.0 * (2 * share - 1)
    sets = [np.frombuffer(b, "<i4") for b in sample["words"].to_pylist()]
    order = sorted(range(len(sets)), key=lambda i: (label[i], sets[i].tobytes()))
    label, sets = label[order], [sets[i] for i in order]
    drawn = {v: (label == v).sum() for v in (0, 1)}
    weights = np.array([sizes[int(v)] / drawn[int(v)] for v in label])
    return fit(sets, label, weights, terms)


def predict(docs: DataFrame, model: tuple[np.ndarray, float], keep_text: bool = False) -> DataFrame:
    """``docs`` with score, 0 to 1, of every whole text; ``text`` stays if asked for.

    Null, empty and word-less texts get the score of no words, which is the bias's. A
    column ``score`` is replaced. The table of weights (2**20 numbers) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        hasher, (table, bias) = _hasher(), shared.value

        def score(part: pa.RecordBatch) -> list[pa.Array]:
            words, heads = hasher.words(part["text"])
            found = _buckets(words)
            counts = np.flatnonzero(table[found])
            row = np.searchsorted(heads, counts, side="right") - 1
            pairs = np.unique(row.astype(np.int64) << BITS | found[counts])
            margin = bias + np.bincount(
                pairs >> BITS, table[pairs & ((1 << BITS) - 1)], minlength=part.num_rows
            )
            return [pa.array(1 / (1 + np.exp(-np.clip(margin, -60, 60))))]

        return score

    docs, restore = set_aside(docs, replaced={f.name for f in FIELDS})
    return restore(append_columns(docs, make, FIELDS, keep_text))
