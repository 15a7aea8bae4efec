"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.staging import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``, both ``bigint``.

    ``root`` is the smallest node that can be reached. Alternates large-star and
    small-star steps: every node's larger, then smaller neighbours are hung on
    the smallest node it knows, until nothing changes, which takes about as
    many rounds as the logarithm of the longest path. Each round is a written
    table, so a lost executor replays one round only. Minima are aggregated
    before they are shuffled; a hub meets its minimum in a join whose large
    side Spark can split. Edges with a null end or equal ends say nothing and
    are left out; repeated edges count once.
    """
    work = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "edges")
    seen = _state(work)
    while seen[0]:
        both = work.unionByName(work.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = work.join(lowest, "v").select("u", F.col("m").alias("v")).filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        passed = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        work = stage(passed.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _state(work)
        if now == seen:
            break
        seen = now
    roots = work.select("v").distinct()
    return work.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def _state(work: DataFrame) -> tuple:
    return tuple(work.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as the links ``a[i] - b[i]``, one per node.

    Every node but the smallest of its component is linked to that one.
    """
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]
