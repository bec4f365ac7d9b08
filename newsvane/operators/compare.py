"""Comparing two scorings of the same articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsvane.functions.labels import opposite
from newsvane.functions.numeric import from_micros, round_to, safe_corr, to_micros


def pair_scorings(left: DataFrame, right: DataFrame, keys: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """Two scorings (keys, score, label) kept in different tables, side by side; keys in both stay.

    ``keys`` identify an article. Two scores of one row need no pairing: name them
    `<name>_score` and `<name>_label` and go on with `compare_pair`.
    """
    sides = [
        side.select(*keys, F.col("score").alias(f"{name}_score"), F.col("label").alias(f"{name}_label"))
        for side, name in zip((left, right), names)
    ]
    return sides[0].join(sides[1], list(keys))


def compare_pair(paired: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Score difference, label agreement, and the label to keep: on conflict the second scorer's."""
    a, b = names
    conflict = F.col(f"{a}_label") != F.col(f"{b}_label")
    return (
        paired.withColumn(
            "score_diff", round_to(F.abs(F.col(f"{b}_score") - F.col(f"{a}_score")), 4)
        )
        .withColumn("is_conflict", F.coalesce(conflict, F.lit(False)))
        .withColumn(
            "final_label",
            F.when(F.col("is_conflict"), F.col(f"{b}_label")).otherwise(F.col(f"{a}_label")),
        )
    )


def label_match_counts(compared: DataFrame) -> DataFrame:
    match = F.when(F.col("is_conflict"), "mismatch").otherwise("match")
    return compared.groupBy(match.alias("label_match")).agg(F.count("*").alias("articles"))


def average_difference(compared: DataFrame) -> DataFrame:
    mean = from_micros(F.sum(to_micros(F.col("score_diff"))) / F.count("*"))
    return compared.agg(round_to(mean, 6).alias("average_score_diff"), F.count("*").alias("articles"))


def agreement_report(compared: DataFrame, names: tuple[str, str]) -> DataFrame:
    """One row: mean absolute difference, agreement and opposition in percent, correlation."""
    a, b = (F.col(f"{n}_score") for n in names)
    la, lb = (F.col(f"{n}_label") for n in names)

    def percent(condition):
        return round_to(F.avg(F.when(condition, 1.0).otherwise(0.0)) * 100.0, 2)

    gap = F.sum(to_micros(F.abs(b - a))) / F.count("*")
    return compared.agg(
        round_to(from_micros(gap), 4).alias("mean_abs_diff"),
        percent(~F.col("is_conflict")).alias("agreement_pct"),
        percent(opposite(la, lb)).alias("opposite_pct"),
        round_to(safe_corr(b, a), 4).alias("pearson"),
    )
