"""Near-duplicate vectors by a forest of random-projection trees.

A tree splits a sample by random directions, each near the median of the
sample's projections, until its leaves are small. Rows close to a split go down
both sides, so that near pairs seldom part in every tree; a split that would
part many of the sample's near pairs is not made, so a large cluster of near
copies stays in one leaf, however large. Within the leaves of
all trees rows are compared exactly; the pairs found are verified by cosine,
counted once whatever leaves they share, and joined into components.

Equal vectors are one row with a weight. A leaf hands on counts and trees of
links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.components import connected_components, spanning
from paperloom.llm.rows import quoted
from paperloom.llm.vectors import dimension, matrix, products, scattered, usable
from paperloom.operators.joins import join_unique
from paperloom.shipping import ship_package
from paperloom.staging import stage

THRESHOLD = 0.95
TREES = 8
# Vectors the trees are fitted on, and the rows a leaf should hold.
SAMPLE = 20_000
LEAF = 1_000
# Sampled vectors a split needs on each side.
SIDE = 8
# Sampled vectors whose near pairs are looked up, and how many of each are kept.
ANCHORS, MATES = 2_000, 16
# Share of a node's near pairs that a split may part, and the pairs that tell it.
PARTED, TELLING = 0.05, 16
# Splits tried near the median, and after them anywhere.
TRIES, WIDE_TRIES = 8, 16
# Rows this near to a split, in deviations of the projections, go both ways.
SPILL = 0.1
# Rows of a leaf that meet in one task; a larger leaf is met in pairs of blocks.
BLOCK = 2_048


@dataclass(frozen=True)
class Forest:
    """Splits of all trees: directions, thresholds, margins, and the two nodes below.

    A node below of ``-1 - leaf`` is a leaf. Leaves are numbered through the
    trees, so the leaves of an earlier tree have smaller numbers.
    """

    roots: list[int]
    directions: np.ndarray
    cuts: np.ndarray
    margins: np.ndarray
    below: np.ndarray
    leaves: int

    @classmethod
    def fitted(cls, unit: np.ndarray, n: int, trees: int, leaf: int, spill: float, seed: int, threshold: float = THRESHOLD) -> "Forest":
        """``unit`` is the sample of ``n`` rows, scaled to unit length."""
        rng = np.random.default_rng(seed)
        small = leaf * len(unit) / max(n, 1)
        roots, directions, cuts, margins, below, leaves = [], [], [], [], [], 0

        def split(rows: np.ndarray, a: np.ndarray, b: np.ndarray, wide: bool):
            """Direction, cut, margin, rows on the left, and the pairs that stay together on each side; None if it serves nothing."""
            direction = rng.normal(size=unit.shape[1])
            direction /= np.sqrt((direction * direction).sum())
            along = unit[rows] @ direction
            cut = float(np.quantile(along, rng.uniform(0.05, 0.95) if wide else rng.uniform(0.4, 0.6))) if len(rows) else 0.0
            left = along <= cut
            if len(rows) <= small or min(left.sum(), (~left).sum()) < SIDE:
                return None
            margin = spill * float(along.std())
            at_a, at_b = unit[a] @ direction - cut, unit[b] @ direction - cut
            both_left, both_right = np.maximum(at_a, at_b) <= margin, np.minimum(at_a, at_b) > -margin
            if len(a) >= TELLING and (~(both_left | both_right)).mean() > PARTED:
                return None
            return direction, cut, margin, left, both_left, both_right

        def grow(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> int:
            nonlocal leaves
            tries = (False,) if len(rows) <= small else (False,) * TRIES + (True,) * WIDE_TRIES
            made = next((x for wide in tries if (x := split(rows, a, b, wide)) is not None), None)
            if made is None:
                leaves += 1
                return -leaves
            direction, cut, margin, left, both_left, both_right = made
            node = len(cuts)
            directions.append(direction)
            cuts.append(cut)
            margins.append(margin)
            below.append(None)
            below[node] = (grow(rows[left], a[both_left], b[both_left]), grow(rows[~left], a[both_right], b[both_right]))
            return node

        near = _near_pairs(unit, threshold, seed)
        for _ in range(trees):
            roots.append(grow(np.arange(len(unit)), *near))
        d = unit.shape[1]
        return cls(roots, np.array(directions).reshape(-1, d), np.array(cuts), np.array(margins), np.array(below, np.int64).reshape(-1, 2), leaves)

    def assign(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the leaves they fall into, ordered by row, then leaf."""
        rows, leaves = [], []
        open_nodes = [(root, np.arange(len(unit))) for root in self.roots]
        while open_nodes:
            node, at = open_nodes.pop()
            if len(at) == 0:
                continue
            if node < 0:
                rows.append(at)
                leaves.append(np.full(len(at), -1 - node))
                continue
            along = unit[at] @ self.directions[node] - self.cuts[node]
            open_nodes.append((self.below[node, 0], at[along <= self.margins[node]]))
            open_nodes.append((self.below[node, 1], at[along > -self.margins[node]]))
        row, leaf = np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *leaves])
        order = np.lexsort((leaf, row))
        return row[order], leaf[order]


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)  # scaled first: squares neither overflow nor vanish
    scaled = vectors / largest
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def _near_pairs(unit: np.ndarray, threshold: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Some pairs within the threshold: up to ``MATES`` of each of ``ANCHORS`` rows."""
    rng = np.random.default_rng([seed, 1])
    anchors = rng.permutation(len(unit))[:ANCHORS]
    firsts, seconds = [], []
    for start in range(0, len(anchors), 256):
        rows = anchors[start : start + 256]
        for row, cosines in zip(rows, unit[rows] @ unit.T):
            mates = np.flatnonzero(cosines >= threshold)
            mates = mates[mates != row]
            if len(mates) > MATES:
                mates = rng.choice(mates, MATES, replace=False)
            firsts.append(np.full(len(mates), row))
            seconds.append(mates)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *firsts]), np.concatenate([none, *seconds])


@dataclass(frozen=True)
class Blocks:
    """How the rows of each leaf are cut into blocks.

    A row's home is its first leaf of several blocks. Rows of a later leaf that
    share a home have met there; where they fill a block they get blocks of
    their own, which meet the leaf's other blocks and not each other.
    ``first`` and ``parts`` follow ``keys``, which are leaf times
    leaves plus home; the other rows of a leaf have its first ``rest`` blocks.
    """

    large: np.ndarray
    rest: np.ndarray
    total: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    parts: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, homes: list[tuple[int, int]]) -> "Blocks":
        """``counts`` are rows of each leaf, ``homes`` pairs of a key and its rows."""
        keys = np.array(sorted(k for k, _ in homes), np.int64)
        held = np.array([n for _, n in sorted(homes)], np.int64)
        leaf = keys // max(1, len(counts))
        rest = counts.copy()
        np.subtract.at(rest, leaf, held)
        rest, parts = -(-rest // BLOCK), -(-held // BLOCK)
        total, first = rest.copy(), np.zeros(len(keys), np.int64)
        for i, at in enumerate(leaf):
            first[i] = total[at]
            total[at] += parts[i]
        return cls(counts > BLOCK, rest, total, keys, first, parts)

    @staticmethod
    def homes(row: np.ndarray, leaf: np.ndarray, large: np.ndarray) -> np.ndarray:
        """For each row and leaf, ordered by both, the row's home, or the number of leaves."""
        home = np.full(row.max(initial=-1) + 1, len(large))
        np.minimum.at(home, row, np.where(large[leaf], leaf, len(large)))
        return home[row]

    def dealt(self, row: np.ndarray, leaf: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``leaf``, each as often as its row meets a block, with its own block and the other."""
        home = self.homes(row, leaf, self.large)
        first, parts = np.zeros(len(leaf), np.int64), np.maximum(self.rest[leaf], 1)
        met = np.zeros(len(leaf), bool)
        if len(self.keys):
            key = leaf * len(self.large) + home
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            met = (self.keys[at] == key) & (home < leaf)
            first[met], parts[met] = self.first[at[met]], self.parts[at[met]]
        own = first + scattered(names) % parts
        meets = np.maximum(self.total[leaf], 1) - np.where(met, parts, 0)
        again = np.repeat(np.arange(len(row)), meets)
        other = np.arange(len(again)) - np.repeat(np.cumsum(meets) - meets, meets)
        other += np.where(met[again] & (other >= first[again]), parts[again], 0)
        return again, own[again], other


def _lists(column: pa.ChunkedArray) -> np.ndarray:
    """Ascending lists as the rows of a matrix, filled up with -1."""
    flat = column.combine_chunks()
    offsets = flat.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.full((len(sizes), max(1, sizes.max(initial=0))), -1, np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def _met_before(a: np.ndarray, b: np.ndarray, leaf: int) -> np.ndarray:
    """Whether two rows' lists share a leaf before this one."""
    out = np.zeros(len(a), bool)
    for column in range(a.shape[1]):
        own = a[:, column : column + 1]
        out |= ((own >= 0) & (own < leaf) & (own == b)).any(axis=1)
    return out


def _compare(table: pa.Table, d: int, threshold: float) -> pa.Table:
    """``node, links, root`` of the rows of one cell: two blocks of a leaf, or one with itself."""
    leaf, low, high = (table[c][0].as_py() for c in ("leaf", "low", "high"))
    nodes, weights, block = table["node"].to_numpy(), table["weight"].to_numpy(), table["block"].to_numpy()
    vectors = matrix(table["embedding"], d)
    unit, lists = _unit(vectors), _lists(table["leaves"])
    lists = lists[:, : max(1, ((lists >= 0) & (lists < leaf)).sum(axis=1).max())]  # ascending: later leaves do not matter
    left = np.flatnonzero(block == low)
    right = left if low == high else np.flatnonzero(block == high)
    links = np.zeros(len(nodes), np.int64)
    tied_a, tied_b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for start in range(0, len(left), 256):
        rows = left[start : start + 256]
        cosines = unit[rows] @ unit[right].T
        i, j = np.nonzero(cosines >= threshold - 1e-9)
        a, b, near = rows[i], right[j], cosines[i, j]
        if low == high:
            once = a < b
            a, b, near = a[once], b[once], near[once]
        edge = np.abs(near - threshold) <= 1e-9
        if edge.any():
            x, y = vectors[a[edge]], vectors[b[edge]]
            near[edge] = products(x, y) / np.sqrt(products(x, x) * products(y, y))
        real = near >= threshold
        a, b = a[real], b[real]
        for at in range(0, len(a), 65_536):
            p, q = a[at : at + 65_536], b[at : at + 65_536]
            first = ~_met_before(lists[p], lists[q], leaf)
            np.add.at(links, p[first], weights[q[first]])
            np.add.at(links, q[first], weights[p[first]])
        if len(a):
            tied_a, tied_b = spanning(np.r_[tied_a, a], np.r_[tied_b, b])
    root = np.arange(len(nodes))
    root[tied_a] = tied_b
    met = (links > 0) | (root != np.arange(len(nodes)))
    return pa.table({"node": nodes[met], "links": links[met], "root": nodes[root[met]]})


def link_vectors(
    distinct: DataFrame, d: int, n: int, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, spill: float = SPILL, seed: int = 0
) -> DataFrame:
    """``node, links, root`` rows of ``distinct`` (``node, weight, embedding``).

    ``links`` adds up, over the rows of a node, to the weights of the nodes
    found within the threshold; edges ``node - root`` connect what is linked.
    """
    spark = distinct.sparkSession
    ship_package(spark)
    drawn = distinct.orderBy(F.hash("node"), "node").select("embedding").limit(sample).toArrow()
    forest = Forest.fitted(_unit(matrix(drawn["embedding"], d)), n, trees, leaf, spill, seed, threshold)
    shared = spark.sparkContext.broadcast(forest)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shared.value.leaves, np.int64)
        for batch in batches:
            total += np.bincount(shared.value.assign(_unit(matrix(batch.column(0), d)))[1], minlength=len(total))
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["leaf", "n"])

    # leaves are as many as the sample can make
    counts = distinct.select("embedding").mapInArrow(sizes, "leaf bigint, n bigint").groupBy("leaf").agg(F.sum("n").alias("n")).collect()
    held = np.zeros(forest.leaves, np.int64)
    for row in counts:
        held[row["leaf"]] = row["n"]
    large = held > BLOCK

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, leaf_of = shared.value.assign(_unit(matrix(batch.column(0), d)))
            home = Blocks.homes(row, leaf_of, large)
            later = large[leaf_of] & (home < leaf_of)
            keys, n = np.unique(leaf_of[later] * len(large) + home[later], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    shares = []
    if held.max(initial=0) > 4 * BLOCK:  # smaller leaves gain little
        sums = distinct.select("embedding").mapInArrow(homes, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
        shares = [tuple(r) for r in sums.filter(F.col("n") >= BLOCK).collect()]
    per_leaf = spark.sparkContext.broadcast(Blocks.of(held, shares))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                row, leaf_of = shared.value.assign(_unit(matrix(batch.column(2), d)))
                bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(leaf_of))
                # a row meets its own block and every other one of its leaf, save those it has met
                again, own, other = per_leaf.value.dealt(row, leaf_of, batch.column(0).to_numpy()[row])
                at = row[again]
                picked = pa.array(at)
                columns = [
                    pa.array(leaf_of[again]),
                    pa.array(np.minimum(own, other)),
                    pa.array(np.maximum(own, other)),
                    pa.array(own),
                    *[batch.column(c).take(picked) for c in range(3)],
                    lists.take(picked),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["leaf", "low", "high", "block", "node", "weight", "embedding", "leaves"])

    dealt = distinct.select("node", "weight", "embedding").mapInArrow(
        deal, "leaf bigint, low bigint, high bigint, block bigint, node bigint, weight bigint, embedding array<double>, leaves array<bigint>"
    )
    return dealt.groupBy("leaf", "low", "high").applyInArrow(lambda t: _compare(t, d, threshold), "node bigint, links bigint, root bigint")


def vector_components(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, **forest) -> DataFrame:
    """One row per row of ``rows``: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows found at a cosine of the threshold or
    more, ``component_id`` is the smallest id that can be reached over them,
    and ``kept`` says whether it is the row's own.

    Null ids and vectors that are null, zero, hold a null, NaN or infinite
    component or have another length than most link with nothing: no links,
    their own component, kept. Repeated rows are rows of their own and link with
    each other; an empty table gives no rows. Cosines are computed in double
    precision from the given numbers. A pair may be missed if it parts in every
    tree, and no pair below the threshold is linked.
    """
    ship_package(rows.sparkSession)
    d = dimension(rows, vector)
    source = rows.select(F.col(quoted(vec_id)).cast("bigint").alias("vec_id"), F.col(quoted(vector)).alias("embedding"))
    takes_part = usable(F.col("embedding")) & F.col("vec_id").isNotNull() & (F.size("embedding") == d)
    # -0.0 counts as 0.0, as it does in grouping
    node = F.when(F.coalesce(takes_part, F.lit(False)), F.xxhash64(F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast("double"))))
    marked = source.withColumn("node", node)
    known = marked.filter("node IS NOT NULL").groupBy("node").agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"), F.first("embedding").alias("e"))
    distinct = stage(known.select("node", "first", "weight", F.col("e").cast("array<double>").alias("embedding")), "vectors")
    met = stage(link_vectors(distinct, d, distinct.count(), threshold, **forest), "vector-links") if d else None
    if met is None:
        return source.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    roots = connected_components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    joined = distinct.select("node", "first", "weight").join(links, "node", "left").join(roots, "node", "left")
    joined = stage(joined.withColumn("root", F.coalesce("root", "node")), "vector-roots")
    lowest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    # vectors without a link or copy stand for themselves
    some = joined.filter("links > 0 OR weight > 1").join(lowest, "root").select("node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = join_unique(marked.select("vec_id", "node"), some, ["node"])
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")
    )
