"""Score-to-label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsvane.config import Thresholds

POSITIVE, NEGATIVE, NEUTRAL = "positive", "negative", "neutral"
SUBJECTIVE, OBJECTIVE = "subjective", "objective"


def _three_way(score: Column, upper: float, lower: float) -> Column:
    return F.when(score >= upper, POSITIVE).when(score <= lower, NEGATIVE).otherwise(NEUTRAL)


def polarity_label(score: Column, cuts: Thresholds = Thresholds()) -> Column:
    return _three_way(score, cuts.polarity_positive, cuts.polarity_negative)


def compound_label(score: Column, cuts: Thresholds = Thresholds()) -> Column:
    return _three_way(score, cuts.compound_positive, cuts.compound_negative)


def subjectivity_label(score: Column, cuts: Thresholds = Thresholds()) -> Column:
    return F.when(score >= cuts.subjective, SUBJECTIVE).otherwise(OBJECTIVE)


def opposite(a: Column, b: Column) -> Column:
    """One side says positive, the other negative."""
    return (a.contains(POSITIVE) & b.contains(NEGATIVE)) | (
        a.contains(NEGATIVE) & b.contains(POSITIVE)
    )
