"""K-means clusters of symbols: every restart and every k at once.

Equal points are counted first, so what is passed over grows with the different points only.
All models (restarts times numbers of clusters) take their steps together. A step is one
pass over the points: each task assigns its points in every model and sends one row of
sums per cluster, and the driver, which holds a few numbers per model, moves the centres.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewire.operators.forests import gathered
from quotewire.operators.keyed import not_null
from quotewire.session import materialize, number_batches

# Features, numbers of clusters, restarts, steps and seed.
CLUSTER_FEATURES = ("sentiment_score", "daily_change_percent", "news_count")
CLUSTERS = 4
ELBOW = range(2, 8)
RESTARTS = 10
ITERATIONS = 300
SEED = 42
#: Sum of the squared ways of a model's centres in its last step, at most.
TOLERANCE = 1e-4
_Z = [f"{c}_z" for c in CLUSTER_FEATURES]
_CELLS = 1 << 19  # distances held at once


def scaled_cluster_features(features: DataFrame) -> DataFrame:
    """Cluster features with mean 0 and population deviation 1 (a constant gives 0)."""
    stats = features.agg(*[
        f(c).alias(f"{c}_{p}")
        for c in CLUSTER_FEATURES
        for f, p in ((F.avg, "mean"), (F.stddev_pop, "sd"))
    ])
    scaled = features.withColumn("_stats", stats.select(F.struct("*")).scalar())

    def standard(c: str) -> Column:
        z = F.try_divide(F.col(c) - F.col(f"_stats.{c}_mean"), F.col(f"_stats.{c}_sd"))
        return F.coalesce(z, F.lit(0.0)).alias(f"{c}_z")

    columns = [standard(c) for c in CLUSTER_FEATURES]
    return scaled.where(not_null(*CLUSTER_FEATURES)).select(*features.columns, *columns)


@dataclass(frozen=True)
class Fits:
    """The best of the restarts for each k: centres by k, and their inertia."""

    centres: dict[int, np.ndarray]
    inertia: dict[int, float]


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each model and its squared distance, both models x points.

    Missing clusters are infinitely far; of equally near ones it is the first.
    """
    missing = np.isnan(centres[..., 0])
    spots = np.where(missing[..., None], 0.0, centres)
    best, least = np.zeros((len(centres), len(points)), np.int32), np.full((len(centres), len(points)), np.inf)
    for cluster in range(centres.shape[1]):
        own = np.flatnonzero(~missing[:, cluster])
        if not len(own):
            continue
        away = sum((points[None, :, i] - spots[own, cluster, i, None]) ** 2 for i in range(points.shape[1]))
        every = len(own) == len(centres)
        near = away < (least if every else least[own])
        if every:
            np.copyto(best, cluster, where=near)
            np.minimum(least, away, out=least)
        else:
            best[own] = np.where(near, cluster, best[own])
            least[own] = np.minimum(least[own], away)
    return best, least


def _pass(points: DataFrame, of_batch: Callable, schema: str) -> DataFrame:
    """``of_batch`` (codes, counts, points) of parts of the points, its rows gathered per task."""
    counted = points if "_n" in points.columns else points.withColumn("_n", F.lit(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            values = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in _Z], axis=1)
            codes = batch["_code"].to_numpy(zero_copy_only=False).view(np.uint64)
            rows = of_batch(codes, batch["_n"].to_numpy(zero_copy_only=False).astype(float), values)
            if rows is not None:
                yield rows

    return counted.select("_code", "_n", *_Z).mapInArrow(run, schema)


def _chance(codes: np.ndarray, model: np.ndarray, draw: int) -> np.ndarray:
    """Uniform numbers in (0, 1), models x points, that depend on point, model and draw only."""
    with np.errstate(over="ignore"):
        x = codes[None, :] + (model[:, None].astype(np.uint64) * np.uint64(64) + np.uint64(draw + 1)) * np.uint64(
            0x9E3779B97F4A7C15
        )
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53 + 2.0**-54


def _seeded(points: DataFrame, ks: np.ndarray) -> np.ndarray:
    """First centres of all models: each new one far from the others with a greater chance.

    A draw is a race: every point runs for a time of an exponential law whose rate is its
    squared distance to the centres so far, and the first to arrive is the next centre (the
    first of n equal points arrives as one of n times the rate does). So a pass over the points needs no total, and one pass serves all models.
    """
    models = np.arange(len(ks))
    centres = np.full((len(ks), int(ks.max()), len(_Z)), np.nan)
    for draw in range(int(ks.max())):

        def race(codes: np.ndarray, counts: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            best = []
            for at in range(0, len(values), max(1, _CELLS // centres[..., 0].size)):
                part = slice(at, at + max(1, _CELLS // centres[..., 0].size))
                rate = _nearest(values[part], centres)[1] if draw else np.ones((len(ks), len(values[part])))
                with np.errstate(divide="ignore"):
                    time = -np.log(_chance(codes[part], models, draw)) / (rate * counts[part])
                first = time.argmin(1)
                best.append((time[models, first], values[part][first]))
            time = np.stack([t for t, _ in best])
            winner = time.argmin(0)
            won = np.stack([v for _, v in best])[winner, models]
            return pa.record_batch(
                [pa.array(models), pa.array(time[winner, models]), *[pa.array(won[:, i]) for i in range(len(_Z))]],
                names=["model", "time", *_Z],
            )

        schema = "model long, time double, " + ", ".join(f"{c} double" for c in _Z)
        place = F.struct("time", *_Z)
        won = _pass(points, race, schema).groupBy("model").agg(F.min(place).alias("first")).collect()
        for row in won:
            if ks[row["model"]] > draw:
                centres[row["model"], draw] = [row["first"][c] for c in _Z]
    return centres


def fit(
    points: DataFrame, ks: Sequence[int], restarts: int = RESTARTS, seed: int = SEED,
    tolerance: float = TOLERANCE,
) -> Fits:
    """The best of ``restarts`` models for every k, by Lloyd's steps.

    ``points`` are :func:`scaled_cluster_features` with a symbol of their own each; results
    depend on the rows alone, not on where they lie. A cluster that loses all its points
    keeps its centre. Steps end when no model moves by more than ``tolerance`` (the sum of
    the squared ways of its centres), after ``ITERATIONS`` at most.
    """
    coded = points.withColumn("_code", F.xxhash64(F.lit(seed), "stock_symbol", *_Z))
    points = materialize(coded.groupBy(*_Z).agg(F.min("_code").alias("_code"), F.count("*").alias("_n")))
    with number_batches(points.sparkSession):
        return _fitted(points, ks, restarts, tolerance)


def _fitted(points: DataFrame, ks: Sequence[int], restarts: int, tolerance: float) -> Fits:
    of = np.repeat(np.array(list(ks), np.int64), restarts)
    centres = _seeded(points, of)
    if np.isnan(centres[:, 0]).any():
        return Fits({}, {})
    width = centres.shape[1]

    def sums(codes: np.ndarray, counts: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        total = np.zeros((len(of) * width, 2 + len(_Z)))
        step = max(1, _CELLS // (len(of) * width))
        for at in range(0, len(values), step):
            part, n = values[at : at + step], counts[at : at + step]
            cluster, away = _nearest(part, centres)
            cell = (cluster + np.arange(len(of))[:, None] * width).ravel()
            counted = lambda w: np.bincount(cell, weights=w, minlength=len(total))
            total[:, 0] += counted(np.tile(n, len(of)))
            total[:, 1] += counted((away * n).ravel())
            for i in range(len(_Z)):
                total[:, 2 + i] += counted(np.tile(part[:, i] * n, len(of)))
        full = np.flatnonzero(total[:, 0])
        return pa.record_batch(
            [pa.array(full), *[pa.array(c) for c in total[full].T]], names=["cell", "n", "inertia", *_Z]
        )

    schema = ", ".join(["cell long", *[f"{c} double" for c in ("n", "inertia", *_Z)]])

    def step() -> tuple[np.ndarray, np.ndarray]:
        rows = _pass(points, sums, schema).groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "inertia", *_Z)])
        inertia, moved = np.zeros(len(of)), centres.copy()
        for row in rows.collect():
            model, cluster = divmod(row["cell"], width)
            inertia[model] += row["inertia"]
            moved[model, cluster] = [row[c] / row["n"] for c in _Z]
        return inertia, moved

    for _ in range(ITERATIONS):
        inertia, moved = step()
        way, centres = np.nansum((moved - centres) ** 2, axis=(1, 2)), moved
        if (way <= tolerance).all():
            break
    inertia, _ = step()
    best = {k: min((i for i in range(len(of)) if of[i] == k), key=lambda i: (inertia[i], i)) for k in ks}
    # Clusters are numbered by their centres, so a number means the same in every run.
    ordered = {k: np.array(sorted(centres[i, :k].tolist())) for k, i in best.items()}
    return Fits(ordered, {k: float(inertia[i]) for k, i in best.items()})


def assigned(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """``points`` with the cluster of the nearest centre; the first of equally near ones."""
    away = [sum((F.col(c) - float(v)) ** 2 for c, v in zip(_Z, centre)) for centre in centres]
    nearest = F.array_position(F.array(*away), F.array_min(F.array(*away))) - 1
    return points.withColumn("cluster", nearest.cast("int"))


def kmeans_elbow(features: DataFrame, ks: Sequence[int] = ELBOW, restarts: int = RESTARTS) -> DataFrame:
    """Inertia for every number of clusters."""
    fits = fit(materialize(scaled_cluster_features(features)), ks, restarts)
    return features.sparkSession.createDataFrame(sorted(fits.inertia.items()), "k int, inertia double")


def kmeans_symbols(features: DataFrame, k: int = CLUSTERS, restarts: int = RESTARTS) -> DataFrame:
    """Cluster features with the cluster of each symbol."""
    points = materialize(scaled_cluster_features(features))
    fits = fit(points, [k], restarts)
    if not fits.centres:
        return points.withColumn("cluster", F.lit(None).cast("int"))
    return assigned(points, fits.centres[k])


def cluster_profile(clusters: DataFrame) -> DataFrame:
    """Size and means of each cluster. Its members are the rows of ``clusters``."""
    return clusters.groupBy("cluster").agg(
        F.count("*").alias("count"),
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.avg("daily_change_percent").alias("avg_performance"),
        F.avg("news_count").alias("avg_news_count"),
    )
