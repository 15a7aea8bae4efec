"""Joining a large table with one that holds each key once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.staging import fits, stage

# Largest unique side that is broadcast whole.
MAX_BROADCAST_ROWS = 500_000
# A key holding more than this share of the large side is hot; there can be
# at most 1 / HOT_SHARE such keys.
HOT_SHARE = 0.001


def join_unique(left: DataFrame, unique: DataFrame, keys: list[str], how: str = "left", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``left`` joined with a table unique in ``keys``; safe for hot keys.

    The unique side is written down, so that its size is known and it is made
    only once. One small in rows and bytes is broadcast. Otherwise the rows of hot keys meet a
    broadcast of just those keys (at most 1 / HOT_SHARE rows), and the rest,
    free of hot keys, is shuffled.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how is left or inner, not {how}")
    unique = stage(unique, "unique")
    if fits(unique, max_rows):
        return left.join(F.broadcast(unique), keys, how)
    counts = left.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = stage(counts.filter(F.col("_n") > left.count() * HOT_SHARE).select(*keys), "hot")
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # rows without a key match nothing and need no shuffle either
    at_once = left.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(unique.join(F.broadcast(hot), keys, "left_semi")), keys, how)
    rest = left.filter(named).join(F.broadcast(hot), keys, "left_anti").join(unique, keys, how)
    joined = at_once.unionByName(rest)
    if how == "inner":
        return joined
    return joined.unionByName(left.filter(~named), allowMissingColumns=True)
