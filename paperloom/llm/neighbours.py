"""Approximate nearest neighbours by multiprobe p-stable hashing.

A hash cuts a few random Gaussian projections into cells; rows of the same
cells share a bucket, in each of several tables. A query visits the buckets of
a table in the order of estimated success, the chance that a neighbour at the
usual distance falls into them, until these chances add up to a target. The
rows of all visited buckets are candidates, ranked by their exact products. The
usual distance is the largest among some sampled queries; a query whose k-th
candidate is still farther than that visits once more, by its own distance.

Largest inner products become smallest distances: rows are scaled by the
largest norm and get one more component that completes them to unit length,
queries are scaled to unit length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.llm.rows import quoted
from paperloom.llm.vectors import dimension, matrix, products, scattered, usable
from paperloom.operators.search import top_k
from paperloom.shipping import ship_package
from paperloom.staging import stage

TABLES, PROJECTIONS, WIDTH = 2, 4, 2.0
# Estimated success at which a query stops in each table.
TARGET = 0.9
# Queries whose exact neighbours tell the usual distance; others may go farther.
SAMPLE_QUERIES = 32
# Rows and queries that meet in one task at most.
GROUP_ROWS, GROUP_QUERIES = 8_192, 32_768
# Buckets of all tables that the driver and tasks list at most.
MAX_BUCKETS = 200_000

_erf = np.vectorize(erf, otypes=[float])


@dataclass(frozen=True)
class Hashes:
    """The projections of every table: ``(table, dimension + 1, projection)``."""

    directions: np.ndarray
    shifts: np.ndarray
    width: float
    largest: float

    @classmethod
    def drawn(cls, d: int, tables: int, projections: int, width: float, largest: float, seed: int) -> "Hashes":
        rng = np.random.default_rng(seed)
        return cls(rng.normal(size=(tables, d + 1, projections)), rng.uniform(0, width, (tables, projections)), width, largest)

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.largest
        return np.c_[scaled, np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(axis=1)))]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return np.c_[vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None], np.zeros(len(vectors))]

    def places(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Projections in cell widths."""
        return (unit @ self.directions[table] + self.shifts[table]) / self.width

    @staticmethod
    def code(cells: np.ndarray) -> np.ndarray:
        """One number for the cells of a bucket. Unit vectors stay far inside its range."""
        out = np.zeros(len(cells), np.int64)
        for column in range(cells.shape[1]):
            out = out * 64 + np.clip(cells[:, column] + 32, 0, 63)
        return out

    @staticmethod
    def cells(code: np.ndarray, projections: int) -> np.ndarray:
        return np.stack([(code >> (6 * (projections - 1 - k)) & 63) - 32 for k in range(projections)], axis=1)


@dataclass(frozen=True)
class Layout:
    """Which group holds a bucket: buckets in order, filled up to ``GROUP_ROWS`` rows.

    For each table: codes of the buckets, their first group, and over how many
    groups a bucket too large for one is dealt.
    """

    codes: list[np.ndarray]
    groups: list[np.ndarray]
    parts: list[np.ndarray]

    @classmethod
    def of(cls, counts: list[tuple[int, int, int]], tables: int) -> "Layout":
        codes, groups, parts, group = [], [], [], 0
        for table in range(tables):
            held, own = 0, sorted((code, n) for t, code, n in counts if t == table)
            first, split = [], []
            for _, n in own:
                pieces = -(-n // GROUP_ROWS)
                if held and held + n > GROUP_ROWS:
                    group, held = group + 1, 0
                first.append(group)
                split.append(pieces)
                held += n
                if pieces > 1:
                    group, held = group + pieces, 0
            codes.append(np.array([c for c, _ in own], np.int64))
            groups.append(np.array(first, np.int64))
            parts.append(np.array(split, np.int64))
            group += 1
        return cls(codes, groups, parts)


def probe_order(places: np.ndarray, codes: np.ndarray, reach: float | np.ndarray, width: float, target: float) -> np.ndarray:
    """Which buckets each query visits: a mask of queries by buckets.

    The chance of a bucket is the product over its cells of the normal mass,
    of deviation ``reach`` (one for all queries, or one each), around the query's
    place. Buckets are visited from the likeliest on until the chances reach
    ``target`` of all there are.
    """
    cells = Hashes.cells(codes, places.shape[1])
    scale = width / np.reshape(reach, (-1, 1))
    chance = np.ones((len(places), len(codes)))
    for k in range(places.shape[1]):
        low, high = cells[:, k].min(), cells[:, k].max()
        edges = (np.arange(low, high + 2)[None, :] - places[:, k : k + 1]) * scale
        mass = np.diff(0.5 * (1 + _erf(edges / 2**0.5)), axis=1)
        chance *= np.maximum(mass, 1e-12)[:, cells[:, k] - low]
    order = np.argsort(-chance, axis=1, kind="stable")
    sums = np.cumsum(np.take_along_axis(chance, order, axis=1), axis=1)
    visited = np.ones(chance.shape, bool)
    visited[:, 1:] = sums[:, :-1] < target * sums[:, -1:]
    mask = np.zeros(chance.shape, bool)
    np.put_along_axis(mask, order, visited, axis=1)
    return mask


def _best(asked: pa.Table, held: pa.Table, d: int, k: int) -> pa.Table:
    """The k best visited rows of one group for each of its queries."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if asked.num_rows and held.num_rows:
        rows, ids = matrix(held["embedding"], d), held["vec_id"].to_numpy()
        buckets, at = np.unique(held["bucket"].to_numpy(), return_inverse=True)
        for start in range(0, asked.num_rows, 512):
            part = asked.slice(start, 512)
            queries, names = matrix(part["embedding"], d), part["query_id"].to_numpy()
            lists = part["buckets"].combine_chunks()
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            named = lists.flatten().to_numpy(zero_copy_only=False)
            near = np.minimum(np.searchsorted(buckets, named), len(buckets) - 1)
            visits = np.zeros((len(queries), len(buckets)), bool)
            real = buckets[near] == named
            visits[owner[real], near[real]] = True
            scores = np.where(visits[:, at] & (names[:, None] != ids[None, :]), queries @ rows.T, -np.inf)
            if scores.shape[1] > k:
                # products in blocks may differ in the last digits: keep what could be among the k best
                floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
                slack = 1e-9 * (1 + np.where(np.isfinite(floor), np.abs(floor), 0))
                keep = (scores >= (floor - slack)[:, None]) & np.isfinite(scores)
            else:
                keep = np.isfinite(scores)
            q, r = np.nonzero(keep)
            exact = np.concatenate([products(queries[q[i : i + 65_536]], rows[r[i : i + 65_536]]) for i in range(0, max(1, len(q)), 65_536)])
            order = np.lexsort((ids[r], -exact, q))
            q, r, exact = q[order], r[order], exact[order]
            first = np.r_[0, np.flatnonzero(np.diff(q)) + 1] if len(q) else np.zeros(0, np.int64)
            place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
            best = place < k
            out["query_id"].append(names[q[best]])
            out["vec_id"].append(ids[r[best]])
            out["score"].append(exact[best])
    kinds = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64}
    return pa.table({n: np.concatenate([np.zeros(0, kinds[n]), *v]) for n, v in out.items()})


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    target: float = TARGET,
    seed: int = 0,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest inner product found for each query.

    Both tables hold ids and vectors; a row of the query's own id is no
    candidate. Scores are inner products of the given numbers in double
    precision, ties go to the smaller id, and rows of equal id and score count
    once. Null ids and vectors that are null, zero, hold a null, NaN or infinite
    component or have another length than most take no part, on either side. A
    query that sees fewer than k candidates gets those it sees; empty tables
    give no rows.

    Every row is indexed. The tables' buckets are counted and laid out over
    groups of bounded size, a larger bucket over several; a query goes once to
    each group it visits, with the buckets it visits there. Queries that find
    their k-th candidate beyond the usual distance, or fewer than k, do so again
    with that distance (or the largest there is), so that the target holds for
    each query by its own neighbours' distance.
    """
    spark = rows.sparkSession
    ship_package(spark)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    d = dimension(rows, vector)
    fit = lambda df, name: df.select(F.col(quoted(vec_id)).cast("bigint").alias(name), F.col(quoted(vector)).cast("array<double>").alias("embedding")).filter(
        F.col(name).isNotNull() & usable(F.col("embedding")) & (F.size("embedding") == d)
    )
    held, asked = fit(rows, "vec_id"), fit(queries, "query_id")
    n_queries = asked.count()
    if d == 0 or n_queries == 0:
        return spark.createDataFrame([], schema)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    largest = held.agg(F.max(norm)).first()[0]
    hashes = Hashes.drawn(d, tables, projections, width, largest, seed)
    reach = _usual_distance(held, asked, k, largest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = hashes.rows(matrix(batch.column(1), d))
            for table in range(tables):
                code = Hashes.code(np.floor(hashes.places(unit, table)).astype(np.int64))
                numbers = pa.array(np.full(len(code), table, np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns, numbers, pa.array(code)], names=["vec_id", "embedding", "table", "bucket"])

    placed = held.mapInArrow(place, "vec_id bigint, embedding array<double>, table int, bucket bigint")
    counts = placed.groupBy("table", "bucket").agg(F.count("*").alias("n")).limit(MAX_BUCKETS + 1).collect()
    if len(counts) > MAX_BUCKETS:
        raise ValueError("too many buckets to list: take fewer projections or wider cells")
    shared = spark.sparkContext.broadcast(Layout.of([tuple(r) for r in counts], tables))

    def visit(asking: DataFrame, n: int) -> DataFrame:
        """What ``n`` queries find in the buckets within their ``reach``."""
        blocks = -(-n // GROUP_QUERIES)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            layout = shared.value
            for batch in place(batches):
                if batch.num_rows == 0:
                    continue
                table, code, ids = batch.column(2)[0].as_py(), batch.column(3).to_numpy(), batch.column(0).to_numpy()
                at = np.searchsorted(layout.codes[table], code)
                group = layout.groups[table][at] + scattered(ids) % layout.parts[table][at]
                for block in range(blocks):
                    numbers = pa.array(np.full(len(ids), block, np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(group), numbers, batch.column(0), batch.column(1), batch.column(3)], names=["group", "block", "vec_id", "embedding", "bucket"]
                    )

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            layout = shared.value
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    unit, ids, far = hashes.queries(matrix(part.column(1), d)), part.column(0).to_numpy(), part.column(2).to_numpy()
                    for table in range(tables):
                        codes, groups, parts = layout.codes[table], layout.groups[table], layout.parts[table]
                        if len(codes) == 0:
                            continue
                        mask = probe_order(hashes.places(unit, table), codes, far, width, target)
                        for group in range(int(groups[0]), int((groups + parts).max())):
                            here = (groups <= group) & (group < groups + parts)
                            who = np.flatnonzero(mask[:, here].any(axis=1))
                            if len(who) == 0:
                                continue
                            inside = mask[np.ix_(who, np.flatnonzero(here))]
                            lists = pa.ListArray.from_arrays(
                                pa.array(np.r_[0, np.cumsum(inside.sum(axis=1))].astype(np.int32)), pa.array(np.broadcast_to(codes[here], inside.shape)[inside])
                            )
                            chosen = part.select([0, 1]).take(pa.array(who))
                            columns = [pa.array(np.full(len(who), group)), pa.array((scattered(ids[who]) % blocks).astype(np.int32)), *chosen.columns, lists]
                            yield pa.RecordBatch.from_arrays(columns, names=["group", "block", "query_id", "embedding", "buckets"])

        dealt = held.mapInArrow(deal, "group bigint, block int, vec_id bigint, embedding array<double>, bucket bigint")
        sent = asking.mapInArrow(ask, "group bigint, block int, query_id bigint, embedding array<double>, buckets array<bigint>")
        met = sent.groupBy("group", "block").cogroup(dealt.groupBy("group", "block"))
        return stage(met.applyInArrow(lambda a, b: _best(a, b, d, k), "query_id bigint, vec_id bigint, score double"), "neighbours")

    place_in = F.dense_rank().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    best = lambda df: df.withColumn("rank", place_in).filter(F.col("rank") <= k).distinct()
    found = visit(asked.withColumn("reach", F.lit(reach)), n_queries)
    # the k-th candidate is no nearer than the k-th neighbour: its distance is reach enough
    last = best(found).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("last"))
    own = F.when(F.col("n") >= k, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("last") / (norm * largest)))).otherwise(2.0)
    wider = asked.join(last, "query_id", "left").select("query_id", "embedding", own.alias("reach")).filter(F.col("reach") > reach * (1 + 1e-9))
    again = stage(wider, "neighbours-again")
    n_again = again.count()
    ranked = best(found.unionByName(visit(again, n_again)) if n_again else found)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _usual_distance(held: DataFrame, asked: DataFrame, k: int, largest: float) -> float:
    """Largest distance, in the hashed space, of some queries to their exact neighbours."""
    some = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(SAMPLE_QUERIES)
    norms = some.select("query_id", F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)).alias("norm"))
    exact = top_k(held, some, k + 1, "dot", "vec_id", "query_id").filter("query_id <> vec_id").join(norms, "query_id").collect()
    far = [max(0.0, 2 - 2 * r["score"] / (r["norm"] * largest)) ** 0.5 for r in exact]
    return max(1e-3, float(np.max(far))) if far else 1.0
