"""What the two vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.rows import quoted


def usable(vector: Column) -> Column:
    """Whether a vector is given, finite in all components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def dimension(df: DataFrame, vector: str) -> int:
    """The most frequent length of the usable vectors; of several the smaller; 0 without one."""
    sizes = df.filter(usable(F.col(quoted(vector)))).groupBy(F.size(F.col(quoted(vector))).alias("d")).count()
    found = sizes.orderBy(F.col("count").desc(), "d").first()
    return found["d"] if found else 0


def matrix(lists: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Lists of ``d`` numbers as rows of doubles."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(lists), d)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, the same for the same two rows wherever they stand."""
    return (a * b).sum(axis=1)


def scattered(ids: np.ndarray) -> np.ndarray:
    """Ids spread evenly over the non-negative 31-bit integers."""
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
