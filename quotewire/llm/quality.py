"""Quality scores learned from trusted positives and unlabelled text.

Positive-unlabelled learning with the non-negative risk estimator (Kiryo et al., 2017):
with a class prior p, positives P and unlabelled texts U, the risk of a scorer g is

    p * E_P[loss(g)] + max(0, E_U[loss(-g)] - p * E_P[loss(-g)])

and descent goes back up where the second part would be negative. Labels of bad texts
are never looked at. The prior is estimated from P and U alone: no threshold may leave U
a smaller share of what passes than the positives in it account for.

A text is described by its form: how often each triple of neighbouring characters occurs,
where small letters, capitals, digits and line ends count as one character each and every
ASCII mark as itself; and by a few shares over its words and lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.llm.samples import bounded_sample, labelled, one_text_per_key
from quotewire.llm.words import WordHasher, append_columns, raw, set_aside, slices
from quotewire.session import materialize

BITS = 10
SHARES = 6
SIZE = (1 << BITS) + SHARES
#: Texts a model is fitted on, about: half positives, half unlabelled.
MAX_TEXTS = 8_000
EPOCHS = 40
BATCH = 256
RATE = 0.02
DECAY = 1e-3
#: Added to the spread of every column before it is scaled by it.
LEAST_SPREAD = 0.003
#: Share of positives that the prior's thresholds let pass, at least.
LEAST_PASSED = 0.3
FIELDS = [T.StructField("score", T.DoubleType())]


class _Form:
    """Rows of numbers that describe the form of texts, all between 0 and 1."""

    def __init__(self):
        kinds = np.zeros(256, np.uint32)
        kinds[:] = 1  # letters, ASCII or not
        kinds[:128] = np.arange(2, 130)
        kinds[ord("A") : ord("Z") + 1] = 0
        kinds[ord("a") : ord("z") + 1] = 1
        kinds[ord("0") : ord("9") + 1] = 2
        self.kinds, self.hasher = kinds, WordHasher()

    def of(self, column: pa.Array) -> np.ndarray:
        data, offsets = raw(column)
        out = np.zeros((len(column), SIZE), np.float32)
        heads = (data & 0xC0) != 0x80
        begins = np.append(0, np.cumsum(heads))[offsets]
        data = data[heads]
        sizes = np.diff(begins)
        rows = np.repeat(np.arange(len(column)), sizes)
        kind = self.kinds[data]
        if len(kind) > 2:
            code = (kind[:-2] * np.uint32(0x9E3779B1) ^ kind[1:-1] * np.uint32(0x85EBCA6B)) + kind[2:]
            bucket = (code * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)
            inside = rows[:-2] == rows[2:]
            place = rows[:-2][inside] * (1 << BITS) + bucket[inside]
            counts = np.bincount(place, minlength=len(column) << BITS).reshape(-1, 1 << BITS)
            out[:, : 1 << BITS] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
        words, first = self.hasher.words(column)
        n_words = np.diff(first)
        kinds_of = np.array([len(np.unique(words[a:b])) for a, b in zip(first, first[1:])])
        some = np.maximum(sizes, 1)
        shares = (
            kinds_of / np.maximum(n_words, 1),
            np.bincount(rows, data == 10, minlength=len(column)) / some * 10,
            np.bincount(rows, kind == 0, minlength=len(column)) / some,
            np.bincount(rows, kind == 2, minlength=len(column)) / some,
            np.minimum(sizes / np.maximum(n_words, 1) / 20, 1),
            np.minimum(np.log1p(n_words) / 10, 1),
        )
        out[:, 1 << BITS :] = np.column_stack(shares)
        return out


def features(texts: DataFrame) -> DataFrame:
    """Rows (label, form) of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = _Form()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                rows = [r.tobytes() for r in form.of(part["text"])]
                yield pa.record_batch([part["label"], pa.array(rows, pa.binary())], names=["label", "form"])

    return texts.select("label", "text").mapInArrow(run, "label int, form binary")


def _logistic(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -60, 60)))


def descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 0) -> np.ndarray:
    """Weights (the last is the bias) of the linear scorer of least non-negative risk."""
    rng = np.random.RandomState(seed)
    w = np.zeros(positive.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second, t = np.zeros_like(w), np.zeros_like(w), 0
    n = max(1, min(len(positive), len(unlabelled)) // BATCH)
    for epoch in range(EPOCHS):
        p_order = np.array_split(rng.permutation(len(positive)), n)
        u_order = np.array_split(rng.permutation(len(unlabelled)), n)
        for p_rows, u_rows in zip(p_order, u_order):
            p, u, real = positive[p_rows], unlabelled[u_rows], w[:-1].astype(np.float32)
            gp, gu = _logistic(p @ real + w[-1]), _logistic(u @ real + w[-1])
            # Slopes of the three losses, for the scorer's value at each text.
            as_bad = prior * np.log1p(-np.minimum(gp, 1 - 1e-12)).mean()
            as_bad -= np.log1p(-np.minimum(gu, 1 - 1e-12)).mean()
            slope_p, slope_u = prior * (gp - 1) / len(p), np.zeros(len(u))
            if as_bad >= 0:
                slope_p, slope_u = slope_p - prior * gp / len(p), gu / len(u)
            else:  # more than the risk can be: walk back on that part alone
                slope_p, slope_u = prior * gp / len(p), -gu / len(u)
            g = slope_p.astype(np.float32) @ p + slope_u.astype(np.float32) @ u
            g = np.append(g, slope_p.sum() + slope_u.sum())
            g[:-1] += DECAY * w[:-1]
            t += 1
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            rate = RATE * (1 - epoch / EPOCHS)
            w = w - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Upper estimate of the share of positives in U, from scores of texts not fitted on.

    For any threshold the share of U that passes is at least the prior times the share of
    P that does. The least ratio over thresholds is returned, each share widened by two
    standard errors towards the safe side.
    """
    cuts = np.quantile(positive, np.linspace(0.005, 1 - LEAST_PASSED, 60))
    passed_p = (positive[None, :] >= cuts[:, None]).mean(1)
    passed_u = (unlabelled[None, :] >= cuts[:, None]).mean(1)
    wide = 2 * np.sqrt(passed_u * (1 - passed_u) / len(unlabelled))
    return float(np.clip(np.min((passed_u + wide) / np.maximum(passed_p, 1e-9)), 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the form and the bias (last), and the prior.

    The prior comes first, from two halves that score each other. Columns are brought to
    one scale for the descent, so that a seldom mark can count as much as a letter.
    """
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(0), 1 / (both.std(0) + LEAST_SPREAD)
    positive, unlabelled = (positive - mean) * scale, (unlabelled - mean) * scale
    prior = 0.5
    for _ in range(2):
        p_scores, u_scores = np.empty(len(positive)), np.empty(len(unlabelled))
        for half in (0, 1):
            w = descend(positive[1 - half :: 2], unlabelled[1 - half :: 2], prior)
            p_scores[half::2] = positive[half::2] @ w[:-1] + w[-1]
            u_scores[half::2] = unlabelled[half::2] @ w[:-1] + w[-1]
        prior = estimate_prior(p_scores, u_scores)
    w = descend(positive, unlabelled, prior)
    return np.append(w[:-1] * scale, w[-1] - float((w[:-1] * scale * mean).sum())), prior


def train(docs: DataFrame, labels: DataFrame, learn: Column, most: int = MAX_TEXTS) -> tuple[np.ndarray, float]:
    """Weights (bias last) and prior, from texts of ``docs`` whose ``learn`` holds.

    Trusted positives are those of quality 1; unlabelled are those without a quality. The
    driver gets the numbers of about ``most`` texts, half of each, whatever the input; of
    rows that repeat a doc_id one text is learned from.
    Without positives the scorer is 0 for all, without unlabelled texts 1.
    """
    trusted = labelled(labels, "quality").select("doc_id", (F.col("quality") == 1).alias("good"))
    rows = docs.where(learn & F.col("text").isNotNull()).select("doc_id", "text")
    role = F.when(F.col("good").isNull(), 0).when(F.col("good"), 1).alias("label")
    roles = rows.select("doc_id").distinct().join(trusted, "doc_id", "left").select("doc_id", role)
    sample = bounded_sample(materialize(roles.where("label IS NOT NULL")), most, "label")
    # The sample is bounded, so it can go to the texts instead of the texts to it.
    found = features(one_text_per_key(rows.join(F.broadcast(sample), "doc_id"))).toArrow()
    label = found["label"].to_numpy()
    forms = np.frombuffer(b"".join(found["form"].to_pylist()), np.float32).reshape(-1, SIZE)
    order = np.lexsort((*forms.T[-SHARES:], label))  # rows come in any order
    label, forms = label[order], forms[order]
    positive, unlabelled = forms[label == 1], forms[label == 0]
    if len(positive) < 2 or len(unlabelled) < 2:
        certain = np.zeros(SIZE + 1)
        certain[-1] = 30.0 if len(positive) else -30.0
        return certain, float(len(positive) > 0)
    return fit(positive, unlabelled)


def predict(docs: DataFrame, weights: np.ndarray, keep_text: bool = False) -> DataFrame:
    """``docs`` with score, 0 to 1, of every whole text; ``text`` stays if asked for.

    Null and empty texts are scored like any other, by the form of no characters. A column
    ``score`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        form, w = _Form(), shared.value

        def score(part: pa.RecordBatch) -> list[pa.Array]:
            out = [
                _logistic(form.of(few["text"]) @ w[:-1] + w[-1])
                for few in slices(part.select(["text"]), "text", 1 << 20)
            ]
            return [pa.array(np.concatenate([*out, np.empty(0)]))]

        return score

    docs, restore = set_aside(docs, replaced={f.name for f in FIELDS})
    return restore(append_columns(docs, make, FIELDS, keep_text))
