"""Feedback analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.joins import join_unique


def count_ratings(feedback: DataFrame, *keys: str) -> DataFrame:
    """Clicks per key as ``n_up``, ``n_down``, ``n_other``."""
    known = F.col("rating").isin("up", "down")
    return feedback.groupBy(*keys).agg(
        F.count_if(F.col("rating") == "up").alias("n_up"),
        F.count_if(F.col("rating") == "down").alias("n_down"),
        F.count_if(~F.coalesce(known, F.lit(False))).alias("n_other"),
    )


def join_feedback(answers: DataFrame, feedback: DataFrame) -> DataFrame:
    """Answers with their click counts, zero without feedback.

    Question and answer meet as one digest, so neither text is shuffled or
    broadcast, and feedback is counted per digest before the join: however
    often one answer was clicked, it arrives as one row. A null question or
    answer matches nothing.
    """
    length = F.length("question").cast("string")  # where the question ends
    pair = F.unhex(F.sha2(F.concat(length, F.lit(":"), F.col("question"), F.col("answer")).cast("binary"), 256))
    counted = count_ratings(feedback.select(pair.alias("_pair"), "rating"), "_pair").filter("_pair IS NOT NULL")
    joined = join_unique(answers.withColumn("_pair", pair), counted, ["_pair"]).drop("_pair")
    return joined.fillna(0, ["n_up", "n_down", "n_other"])


def feedback_rates(feedback: DataFrame, *keys: str) -> DataFrame:
    """Counts by rating and the helpful share among up and down."""
    rates = count_ratings(feedback, *keys)
    rated = F.col("n_up") + F.col("n_down")
    return rates.withColumn("helpful_share", F.when(rated > 0, F.round(F.col("n_up") / rated, 6)))
