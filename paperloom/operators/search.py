"""Top-k similarity search over a vector table.

Scores are block products computed inside the tasks that read the index, and a
task hands on only its own k best rows per question. No pair of question and
chunk ever becomes a row, so the one shuffle (by question) moves at most
``k * partitions`` rows per question, whatever the index holds.

Scores are rounded to 6 decimals before ranking; ties break by chunk id.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from paperloom.staging import scratch_path

# Questions sent to every task: bounded in number and in matrix cells.
MAX_QUERIES = 2_000
MAX_QUERY_CELLS = 8_000_000
# Lengths that the vectors of one set of questions may have.
MAX_LENGTHS = 8
# Cells of one score or vector block inside a task (doubles).
BLOCK_CELLS = 2_000_000
# A score that is this far below another before rounding is below it after, too.
ROUNDING = 2e-6


class QueryMatrix:
    """Question vectors as one dense matrix over the columns they use."""

    def __init__(self, ids: list, vectors: np.ndarray, columns: np.ndarray | None, metric: str):
        self.ids = np.array(ids, dtype=object)
        self.columns = columns  # sparse vectors: the buckets in use, sorted
        self.metric = metric
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        if metric == "cosine":
            vectors = vectors / np.where(self.norms > 0, self.norms, 1.0)[:, None]
        self.vectors = vectors.T.copy()

    @classmethod
    def of(cls, table: pa.Table, query_col: str, metric: str) -> "QueryMatrix":
        table = table.combine_chunks()
        ids = table.column(query_col).to_pylist()
        if "embedding" in table.column_names:
            return cls(ids, _dense(_flat(table, "embedding"), len(ids)), None, metric)
        buckets = _flat(table, "buckets")
        columns = np.unique(pc.list_flatten(buckets).to_numpy(zero_copy_only=False))
        return cls(ids, _scatter(buckets, _flat(table, "weights"), columns), columns, metric)

    def only(self, questions: np.ndarray) -> "QueryMatrix":
        """The matrix of some of the questions, with all its columns."""
        part = copy(self)
        part.vectors, part.norms = self.vectors[:, questions], self.norms[questions]
        return part

    def slices(self, step: int) -> list["QueryMatrix"]:
        """The questions in pieces of so many, with all columns."""
        parts = []
        for start in range(0, max(1, len(self.ids)), step):
            part = copy(self)
            at = slice(start, start + step)
            part.ids, part.vectors, part.norms = self.ids[at], self.vectors[:, at], self.norms[at]
            parts.append(part)
        return parts

    def block(self, table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray | None]:
        """Index rows as a matrix over the columns, and their squared lengths where a metric needs them."""
        if self.columns is not None:
            block = _scatter(_flat(table, "buckets"), _flat(table, "weights"), self.columns)
            return block, (block * block).sum(axis=1) if self.metric == "euclidean" else None
        block = _dense(_flat(table, "embedding"), table.num_rows)
        return block, None if self.metric == "dot" else (block * block).sum(axis=1)

    def raw(self, block: np.ndarray, squares: np.ndarray | None) -> np.ndarray:
        """Scores before rounding, of distances their negative squares: one row per index row; larger is better."""
        if self.metric == "euclidean":
            return -np.maximum(squares[:, None] + (self.norms**2)[None, :] - 2 * block @ self.vectors, 0.0)
        result = block @ self.vectors
        if self.metric == "cosine" and self.columns is None:
            norms = np.sqrt(squares)
            result /= np.where(norms > 0, norms, 1.0)[:, None]
        return result

    def rounded(self, raw: np.ndarray) -> np.ndarray:
        return -np.round(np.sqrt(-raw), 6) if self.metric == "euclidean" else np.round(raw, 6)

    def may_reach(self, least: np.ndarray) -> np.ndarray:
        """From which raw score on a rounded one may be ``least``."""
        slack = ROUNDING + 1e-9 * np.abs(least)
        if self.metric == "euclidean":
            return -((np.maximum(-least, 0.0) + slack) ** 2)
        return least - slack

    def scores(self, table: pa.Table | pa.RecordBatch) -> np.ndarray:
        """Rounded scores, one row per index row; larger is better."""
        return self.rounded(self.raw(*self.block(table)))

    def rows_per_block(self) -> int:
        width = max(len(self.ids), self.vectors.shape[0], 1)
        return max(1, BLOCK_CELLS // width)


def _flat(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    column = table.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _dense(lists: pa.Array, n: int) -> np.ndarray:
    values = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(n, -1) if n else np.zeros((0, 0))


def _scatter(buckets: pa.Array, weights: pa.Array, columns: np.ndarray) -> np.ndarray:
    block = np.zeros((len(buckets), len(columns)))
    if len(columns) == 0:
        return block
    lengths = pc.fill_null(pc.list_value_length(buckets), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(buckets)), lengths)
    names = pc.list_flatten(buckets).to_numpy(zero_copy_only=False)
    values = pc.list_flatten(weights).to_numpy(zero_copy_only=False)
    at = np.minimum(np.searchsorted(columns, names), len(columns) - 1)
    used = columns[at] == names
    block[rows[used], at[used]] = values[used]
    return block


class Best:
    """The k best (question, row id, score) seen so far in one task."""

    def __init__(self, queries: QueryMatrix, k: int, min_score: float | None, distinct: bool = False):
        self.queries, self.k, self.min_score, self.distinct = queries, k, min_score, distinct
        self.q = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=object)
        self.s = np.zeros(0)
        # what a row must reach to be among the k best
        self.least = np.full(len(queries.ids), -np.inf)

    def add(self, table: pa.Table | pa.RecordBatch, id_col: str, asked: np.ndarray | None = None) -> None:
        """Score the rows for all questions, or for those ``asked``."""
        queries = self.queries if asked is None else self.queries.only(asked)
        for start in range(0, table.num_rows, self.queries.rows_per_block()):
            part = table.slice(start, self.queries.rows_per_block())
            self.add_block(*queries.block(part), _ids(part, id_col), queries, asked)

    def add_block(self, block: np.ndarray, squares: np.ndarray | None, ids: np.ndarray, queries: QueryMatrix, asked: np.ndarray | None = None) -> None:
        raw = queries.raw(block, squares)
        least = self.least if asked is None else self.least[asked]
        if self.distinct and len(ids):
            ids, raw = _best_of_equal(ids, raw)
        n, reach = raw.shape[0], queries.may_reach(least)
        new = np.flatnonzero(np.isneginf(least))
        if n > self.k and len(new):  # nothing to beat yet: the k best of this block
            some = raw if len(new) == raw.shape[1] else raw[:, new]
            reach[new] = queries.may_reach(queries.rounded(np.partition(some, n - self.k, axis=0)[n - self.k]))
        # few rows reach that, and only those are rounded
        rows, qs = np.divmod(np.flatnonzero(raw >= reach), max(1, raw.shape[1]))
        scores = queries.rounded(raw[rows, qs])
        keep = scores >= least[qs]
        if self.min_score is not None:
            keep &= scores > self.min_score
        if keep.any():
            rows, qs = rows[keep], qs[keep]
            self.q = np.concatenate([self.q, qs if asked is None else asked[qs]])
            self.ids = np.concatenate([self.ids, ids[rows]])
            self.s = np.concatenate([self.s, scores[keep]])
            self._cut()

    def _cut(self) -> None:
        # numpy sorts object ids by Python order: code points, as Spark does
        _, id_rank = np.unique(self.ids, return_inverse=True)
        order = np.lexsort((id_rank, -self.s, self.q))
        if self.distinct:  # of an id's rows the first, which is its best
            _, firsts = np.unique(np.stack([self.q[order], id_rank[order]]), axis=1, return_index=True)
            order = order[np.sort(firsts)]
        q = self.q[order]
        starts = np.r_[0, np.flatnonzero(np.diff(q)) + 1] if len(q) else np.zeros(0, dtype=np.int64)
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
        last = order[place == self.k - 1]
        self.least[self.q[last]] = self.s[last]
        order = order[place < self.k]
        self.q, self.ids, self.s = self.q[order], self.ids[order], self.s[order]

    def result(self, schema: pa.Schema) -> pa.RecordBatch:
        sign = -1.0 if self.queries.metric == "euclidean" else 1.0
        columns = [self.queries.ids[self.q], self.ids, sign * self.s + 0.0]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _ids(table: pa.Table | pa.RecordBatch, id_col: str) -> np.ndarray:
    return np.array(table.column(id_col).to_pylist(), dtype=object)


def _best_of_equal(ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id once, with the largest score of its rows for every question."""
    names, code = np.unique(ids, return_inverse=True)
    order = np.argsort(code, kind="stable")
    starts = np.searchsorted(code[order], np.arange(len(names)))
    return names, np.maximum.reduceat(scores[order], starts, axis=0)


def finite(vector: str) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(whole & (F.size(vector) > 0), F.lit(False))


def _arrow_type(t: T.DataType) -> pa.DataType:
    return {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[t.simpleString()]


def top_k(
    index: DataFrame,
    queries: DataFrame,
    k: int = 3,
    metric: str = "cosine",
    id_col: str = "chunk_id",
    query_col: str = "query_id",
    min_score: float | None = None,
    max_queries: int = MAX_QUERIES,
    max_cells: int = MAX_QUERY_CELLS,
    distinct: bool = False,
) -> DataFrame:
    """The k best index rows per question: ``(query, rank, id, score)``.

    Both sides hold either ``embedding`` (dense) or ``buckets, weights``
    (sparse unit vectors). ``metric`` is ``cosine``, ``dot`` or ``euclidean``.
    Dense vectors that are null or hold a null, NaN or infinite value are no
    candidates and find nothing; ``validate_vectors`` lists them. A question
    meets only vectors of its own length; questions of several lengths are
    searched length by length, of more than ``MAX_LENGTHS`` they are refused.
    Questions within the bounds are broadcast and the index is read in place;
    more questions than that come in blocks, each a further reading. With
    ``distinct`` rows of equal id are one hit that scores as the best of them;
    a task then hands on its k best ids, however many rows each has.
    """
    if metric not in ("cosine", "dot", "euclidean"):
        raise ValueError(f"unknown metric {metric}")
    vector = ["embedding"] if "embedding" in index.columns else ["buckets", "weights"]
    index = index.select(id_col, *vector)
    queries = queries.select(query_col, *vector)
    if vector == ["embedding"]:  # one NaN would spoil the comparisons of a block
        index, queries = index.filter(finite("embedding")), queries.filter(finite("embedding"))
    schema = T.StructType(
        [
            T.StructField(query_col, queries.schema[query_col].dataType),
            T.StructField(id_col, index.schema[id_col].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    table = queries.limit(max_queries + 1).toArrow()
    if vector == ["embedding"] and table.num_rows:
        lengths = _lengths(queries, table if table.num_rows <= max_queries else None)
        if len(lengths) > 1:
            settings = dict(k=k, metric=metric, id_col=id_col, query_col=query_col, min_score=min_score, max_queries=max_queries, max_cells=max_cells, distinct=distinct)
            found = [top_k(index, queries.filter(F.size("embedding") == n), **settings) for n in lengths]
            return reduce(DataFrame.unionByName, found)
        index = index.filter(F.size("embedding") == lengths[0])
    if table.num_rows == 0:
        best = index.sparkSession.createDataFrame([], schema)
    elif table.num_rows <= max_queries and _cells(table) <= max_cells:
        best = _scan(index, QueryMatrix.of(table, query_col, metric), k, id_col, min_score, schema, distinct=distinct)
    else:
        best = _in_blocks(index, queries, k, metric, id_col, query_col, min_score, schema, max_queries, max_cells, distinct)
    if distinct:
        best = best.groupBy(query_col, id_col).agg((F.min if metric == "euclidean" else F.max)("score").alias("score"))
    order = F.col("score").asc() if metric == "euclidean" else F.col("score").desc()
    ranked = Window.partitionBy(query_col).orderBy(order, F.col(id_col))
    return best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select(query_col, "rank", id_col, "score")


def _lengths(queries: DataFrame, table: pa.Table | None) -> list[int]:
    """The lengths of the questions' vectors; ``table`` has all of them, if there are few."""
    if table is not None:
        found = pc.unique(pc.list_value_length(table.column("embedding"))).to_pylist()
    else:
        found = [r["n"] for r in queries.select(F.size("embedding").alias("n")).distinct().limit(MAX_LENGTHS + 1).collect()]
    if len(found) > MAX_LENGTHS:
        raise ValueError(f"question vectors of more than {MAX_LENGTHS} lengths")
    return sorted(found)


def _cells(table: pa.Table) -> int:
    """Cells of the dense matrix of these questions, before it is made."""
    if "embedding" in table.column_names:
        return pc.sum(pc.list_value_length(table.column("embedding"))).as_py() or 0
    return table.num_rows * pc.count_distinct(pc.list_flatten(table.column("buckets"))).as_py()


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, pa.float64() if f.name == "score" else _arrow_type(f.dataType)) for f in schema.fields])


def _scan(
    index: DataFrame,
    matrix: QueryMatrix,
    k: int,
    id_col: str,
    min_score: float | None,
    schema: T.StructType,
    visits: dict[int, np.ndarray] | None = None,
    distinct: bool = False,
    step: int | None = None,
) -> DataFrame:
    """Each task's k best rows per question. With ``visits`` a row is scored for
    the questions that visit its ``cell`` only; with ``step`` so many questions
    are worked on at a time."""
    shared = index.sparkSession.sparkContext.broadcast((matrix, visits))
    out = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, lists = shared.value
        bests = [Best(part, k, min_score, distinct) for part in (queries.slices(step) if step else [queries])]
        for batch in batches:
            if lists is None:
                rows = bests[0].queries.rows_per_block()
                for start in range(0, batch.num_rows, rows):
                    part = batch.slice(start, rows)
                    block, ids = queries.block(part), _ids(part, id_col)
                    for best in bests:
                        best.add_block(*block, ids, best.queries)
                continue
            cells = batch.column("cell").to_numpy(zero_copy_only=False)
            for cell in np.unique(cells):
                bests[0].add(batch.filter(pa.array(cells == cell)), id_col, lists[int(cell)])
        for best in bests:
            if len(best.q):
                yield best.result(out)

    return index.mapInArrow(run, schema)


def _bounded(table: pa.Table, max_cells: int) -> Iterator[pa.Table]:
    """Questions in pieces whose matrix is within the bound, or one question."""
    if table.num_rows > 1 and _cells(table) > max_cells:
        half = table.num_rows // 2
        yield from _bounded(table.slice(0, half), max_cells)
        yield from _bounded(table.slice(half), max_cells)
    elif table.num_rows:
        yield table


def question_groups(queries: DataFrame, query_col: str, max_cells: int) -> Iterator[pa.Table]:
    """Any number of questions in groups within ``max_cells`` cells, one at a time on the driver."""
    if "embedding" in queries.columns:
        rows, width = queries.agg(F.count("*"), F.max(F.size("embedding"))).first()
    else:
        rows = queries.count()
        width = queries.select(F.explode("buckets").alias("b")).distinct().count()
    # Half the bound: dealing by hash leaves groups of slightly unequal size.
    n = max(1, ceil(rows * max(width or 0, 1) / max(1, max_cells // 2)))
    path = scratch_path(queries.sparkSession, "questions")
    dealt = queries.withColumn("_group", F.pmod(F.xxhash64(query_col), F.lit(n)).cast("int"))
    dealt.repartition(n, "_group").write.partitionBy("_group").parquet(path)
    written = queries.sparkSession.read.schema(dealt.schema).parquet(path)
    for group in range(n):
        yield from _bounded(written.filter(F.col("_group") == group).drop("_group").toArrow(), max_cells)


def question_blocks(queries: DataFrame, query_col: str, max_queries: int, max_cells: int) -> Iterator[pa.Table]:
    """The questions of each group in blocks of bounded rows."""
    for table in question_groups(queries, query_col, max_cells):
        for start in range(0, table.num_rows, max_queries):
            yield table.slice(start, max_queries)


def _in_blocks(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str,
    id_col: str,
    query_col: str,
    min_score: float | None,
    schema: T.StructType,
    max_queries: int,
    max_cells: int,
    distinct: bool,
) -> DataFrame:
    """Exact search for any number of questions.

    Group after group is broadcast, as many questions as ``max_cells`` admits,
    and the index read in place; a task takes ``max_queries`` of them at a time.
    So readings follow from the cells, the vectors of the index are never
    shuffled or copied, and what is written is each group's best rows.
    """
    out = scratch_path(index.sparkSession, "blocks")
    for number, table in enumerate(question_groups(queries, query_col, max_cells)):
        found = _scan(index, QueryMatrix.of(table, query_col, metric), k, id_col, min_score, schema, distinct=distinct, step=max(1, max_queries))
        found.write.parquet(f"{out}/block={number}")
    return index.sparkSession.read.schema(schema).parquet(out).select(*schema.fieldNames())
