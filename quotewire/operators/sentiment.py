"""Article scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewire.functions.common import let
from quotewire.functions.dates import now_utc
from quotewire.functions.labels import (
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    lexicon_sentiment,
    short_text_guard,
)
from quotewire.functions.text import pick_text

SCORED = "label string, score double"

# A loader runs once per Python worker and returns a function that scores a batch
# of texts into a frame with the columns label and score.
BatchScorer = Callable[[pd.Series], pd.DataFrame]
ScorerLoader = Callable[[], BatchScorer]
Scorer = Callable[[Column], Column]

MIN_BATCH = 20
TEXT_COLUMNS = ("text_raw", "clean_text", "headline")


def with_lexicon_sentiment(
    articles: DataFrame, positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS, text: str = "text_raw"
) -> DataFrame:
    """Adds sentiment_label and sentiment_score by word lists."""
    return (
        articles.withColumn("_s", lexicon_sentiment(F.col(text), positive, negative))
        .withColumns({"sentiment_label": F.col("_s.label"), "sentiment_score": F.col("_s.score")})
        .drop("_s")
    )


def model_scorer(load: ScorerLoader, max_failed: float = 0.5) -> Scorer:
    """Column function for a model: loaded once per worker, fed in Arrow batches.

    A row whose scoring fails becomes neutral 0.0; a failing batch is scored row by
    row to find it. A batch of ``MIN_BATCH`` texts or more of which over ``max_failed``
    fail is an error: the model is broken, not a text.
    """

    def score_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = load()

        def one(text: str) -> pd.DataFrame | Exception:
            try:
                return scorer(pd.Series([text]))
            except Exception as error:  # the model is foreign code: any failure means "neutral"
                return error

        for texts in batches:
            texts = texts.reset_index(drop=True)
            try:
                scored = scorer(texts)
            except Exception:
                found = [one(t) for t in texts]
                errors = [f for f in found if isinstance(f, Exception)]
                if len(texts) >= MIN_BATCH and len(errors) > max_failed * len(texts):
                    raise RuntimeError(f"{len(errors)} of {len(texts)} texts failed") from errors[-1]
                neutral = pd.DataFrame({"label": ["neutral"], "score": [0.0]})
                scored = pd.concat(
                    [neutral if isinstance(f, Exception) else f for f in found], ignore_index=True
                )
            yield scored[["label", "score"]]

    # functions defined under postponed annotations need resolved types here
    score_batches.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(score_batches, returnType=SCORED)


def lexicon_scorer(
    positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS
) -> Scorer:
    """The built-in scorer by word lists, with lower-case labels."""

    def lowered(scored: Column) -> Column:
        return F.struct(F.lower(scored["label"]).alias("label"), scored["score"].alias("score"))

    return lambda text: let(lexicon_sentiment(text, positive, negative), lowered)


def score_articles(
    articles: DataFrame, scorer: Scorer | None = None
) -> DataFrame:
    """Adds sentiment_label, sentiment_score (4 places) and sentiment_analyzed_at.

    Texts are the first non-empty of text_raw, clean_text and headline; texts under
    ten characters are neutral. ``scorer`` maps a text column to a struct (label, score);
    the default is :func:`lexicon_scorer`, a model comes by :func:`model_scorer`.
    """
    present = [F.col(c) for c in TEXT_COLUMNS if c in articles.columns]
    return (
        articles.withColumn("_text", pick_text(*present))
        .withColumn("_s", (scorer or lexicon_scorer())(F.col("_text")))
        .withColumn("_s", short_text_guard(F.col("_text"), F.col("_s")))
        .withColumns({
            "sentiment_label": F.col("_s.label"),
            "sentiment_score": F.round("_s.score", 4),
            "sentiment_analyzed_at": now_utc(),
        })
        .drop("_text", "_s")
    )
