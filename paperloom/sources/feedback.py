"""The feedback log: JSON lines of question, answer and rating."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FEEDBACK_SCHEMA = "question string, answer string, rating string"
CORRUPT = "_corrupt"


def append_feedback(df: DataFrame, path: str) -> None:
    """S6"""
    df.select("question", "answer", "rating").write.mode("append").json(path)


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are no such JSON are kept in ``_corrupt``."""
    schema = f"{FEEDBACK_SCHEMA}, {CORRUPT} string"
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)
