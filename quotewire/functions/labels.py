"""Sentiment labels and the word-list scorer."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotewire.functions.common import let
from quotewire.functions.text import strip

# The default word lists, matched as substrings.
POSITIVE_WORDS = (
    "improved", "increased", "growth", "positive", "strong", "exceeded",
    "upgrade", "profit", "record", "success", "breakthrough", "launch",
    "gains", "rally", "bullish", "surge", "recovery", "optimistic",
)
NEGATIVE_WORDS = (
    "decreased", "decline", "loss", "negative", "weak", "missed",
    "downgrade", "risk", "concern", "struggle", "drop", "fall",
    "bearish", "plunge", "tumble", "dip", "volatile", "pessimistic",
)


def sentiment_type(score: Column) -> Column:
    """Day mood of a 0..1 average."""
    return F.when(score >= 0.6, "Positive").when(score <= 0.4, "Negative").otherwise("Neutral")


def sentiment_level(score: Column) -> Column:
    """Article mood of a 0..1 score."""
    return F.when(score <= 0.3, "Negative").when(score <= 0.7, "Neutral").otherwise("Positive")


def compound_label(score: Column) -> Column:
    """Label of a -1..1 compound score."""
    return F.when(score >= 0.05, "positive").when(score <= -0.05, "negative").otherwise("neutral")


def signed_score(label: Column, confidence: Column) -> Column:
    """A classifier's confidence, signed by its label."""
    return (
        F.when(label == "negative", -confidence)
        .when(label == "neutral", F.lit(0.0))
        .otherwise(confidence)
    )


def short_text_guard(text: Column, scored: Column, minimum: int = 10) -> Column:
    """``scored`` (struct of label, score), or neutral where the text says too little."""
    neutral = F.struct(F.lit("neutral").alias("label"), F.lit(0.0).alias("score"))
    long_enough = F.coalesce(F.length(strip(text)) >= minimum, F.lit(False))
    return F.when(long_enough, scored).otherwise(neutral)


def _words_present(lowered: Column, words: Sequence[str]) -> Column:
    return reduce(Column.__add__, [lowered.contains(w).cast("int") for w in words], F.lit(0))


def lexicon_sentiment(
    text: Column,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> Column:
    """Struct (label, score) from how many listed words occur in the text.

    Every 0.2 per word of lead on top of 0.3, at most 0.9, signed by the leader.
    """
    def lead(lowered: Column) -> Column:
        return _words_present(lowered, positive) - _words_present(lowered, negative)

    def scored(lead: Column) -> Column:
        size = F.least(F.lit(0.9), F.lit(0.3) + F.abs(lead) * F.lit(0.2))
        label = F.when(lead > 0, "POSITIVE").when(lead < 0, "NEGATIVE").otherwise("NEUTRAL")
        return F.struct(
            label.alias("label"),
            F.when(lead > 0, size).when(lead < 0, -size).otherwise(F.lit(0.0)).alias("score"),
        )

    return let(let(F.lower(F.coalesce(text, F.lit(""))), lead), scored)
