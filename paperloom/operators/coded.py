"""Approximate search over product-quantised codes.

A coarse quantiser deals vectors to lists; what is left of a vector after its
list's center is cut into sub-vectors, and each is written as the number of the
nearest entry of that part's codebook: one byte for several numbers. A question
looks into the lists nearest to it only, is multiplied with what the codes stand
for, and the best candidates are scored again with their whole vectors. Centers and codebooks are fitted on a bounded sample; every vector is
coded.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from paperloom.operators.retrieval import _matrix, usual_length
from paperloom.operators.search import MAX_QUERIES, MAX_QUERY_CELLS, QueryMatrix, _arrow_schema, finite, question_groups
from paperloom.shipping import ship_package
from paperloom.staging import scratch_path

# Vectors that centers and codebooks are fitted on, at most.
SAMPLE = 50_000
# Entries of a codebook, each named by one byte, and numbers of a vector that share a byte.
ENTRIES = 256
PART = 4
# Lists are as many as the square root of the rows, within these bounds.
MIN_LISTS, MAX_LISTS = 16, 4096
# Rounds of fitting; vectors in a file of the index at most, and so many at least where each core has a file.
ROUNDS = 12
FILE_ROWS = 1_000_000
MIN_FILE_ROWS = 2_000
# Candidates per question and wanted hit that are scored again, and lists looked into.
RESCORED = 20
PROBED = 0.25
# Cells of the vectors that a task works on at a time, of a block of scores, and of the table of questions and lists.
HELD_CELLS = 8_000_000
SCORE_CELLS = 4_000_000
VISIT_CELLS = 64_000_000
# Of so many rows for each candidate, or fewer, all are multiplied with the question.
DENSE_SHARE = 16


def _nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The nearest center of each row, in slices of bounded size."""
    half = (centers * centers).sum(axis=1) / 2
    step = max(1, 4_000_000 // max(1, len(centers)))
    return np.concatenate([(rows[i : i + step] @ centers.T - half).argmax(axis=1) for i in range(0, len(rows), step)] or [np.zeros(0, np.int64)])


def fit_centers(rows: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """``n`` centers of the rows, or all distinct rows where there are fewer.

    Starts from rows drawn by seed; a center that loses all rows is put on the
    row farthest from its own.
    """
    distinct = np.unique(rows, axis=0)
    if len(distinct) <= n:
        return distinct
    rng = np.random.default_rng(seed)
    centers = distinct[rng.permutation(len(distinct))[:n]].copy()
    for _ in range(ROUNDS):
        at = _nearest(rows, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, at, rows)
        counts = np.bincount(at, minlength=n)
        filled = counts > 0
        centers[filled] = sums[filled] / counts[filled, None]
        if not filled.all():
            far = ((rows - centers[at]) ** 2).sum(axis=1).argsort()[::-1]
            centers[~filled] = rows[far[: (~filled).sum()]]
    return centers


@dataclass(frozen=True)
class Codebook:
    """Centers of the lists, and of each sub-space the entries (``parts, entries, width``)."""

    centers: np.ndarray
    entries: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, n_lists: int, seed: int = 0) -> "Codebook":
        centers = fit_centers(sample, n_lists, seed)
        width = PART if sample.shape[1] % PART == 0 else 1
        rest = sample - centers[_nearest(sample, centers)]
        books = []
        for part in range(sample.shape[1] // width):
            book = fit_centers(rest[:, part * width : (part + 1) * width], ENTRIES, seed + part)
            books.append(np.concatenate([book, np.repeat(book[:1], ENTRIES - len(book), axis=0)]))
        return cls(centers, np.stack(books))

    def code(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and codes of each row."""
        lists = _nearest(rows, self.centers)
        rest = rows - self.centers[lists]
        width = self.entries.shape[2]
        codes = [_nearest(rest[:, p * width : (p + 1) * width], book) for p, book in enumerate(self.entries)]
        return lists, np.stack(codes, axis=1).astype(np.uint8)

    def decode(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The vectors that lists and codes stand for."""
        return self.centers[lists] + np.concatenate([self.entries[p][codes[:, p]] for p in range(codes.shape[1])], axis=1)

    def tables(self, questions: np.ndarray) -> np.ndarray:
        """What each entry adds to a question's product: ``parts, entries, questions``."""
        parts, _, width = self.entries.shape
        return np.matmul(self.entries, questions.reshape(len(questions), parts, width).transpose(1, 2, 0))


@dataclass(frozen=True)
class CodedIndex:
    """Codes beside whole vectors, sorted by list, and the codebook that made them."""

    path: str
    table: DataFrame
    book: Codebook
    id_col: str
    dim: int

    def search(
        self, queries: DataFrame, k: int = 3, n_probe: int | None = None, rescored: int = RESCORED, query_col: str = "query_id", max_queries: int = MAX_QUERIES
    ) -> DataFrame:
        """About the k nearest by cosine, ``(query, rank, id, score)`` with exact scores.

        Each question looks into its ``n_probe`` nearest lists (by default a
        quarter of them). A task scores the ``rescored * k`` best codes of a
        question again, with the whole vectors that lie beside them, and hands
        on the k best of those; so no candidate is a row of its own, and an
        index of several files, or of large ones, has as many scored again for each
        ``HELD_CELLS`` of vectors. Questions are taken in blocks of bounded size, as many in one reading as their
        matrix admits; a question whose vector is null, not finite or of
        another length finds nothing, a zero one has score 0 everywhere. More
        lists and more rescoring find more of the exact hits; with all of both
        the result is that of ``top_k``.
        """
        spark = self.table.sparkSession
        ship_package(spark)
        asked = queries.select(query_col, "embedding").filter(finite("embedding") & (F.size("embedding") == self.dim))
        schema = T.StructType([asked.schema[query_col], self.table.schema[self.id_col], T.StructField("score", T.DoubleType())])
        probe = min(n_probe or max(1, round(PROBED * len(self.book.centers))), len(self.book.centers))
        out = scratch_path(spark, "coded")
        spark.createDataFrame([], schema).write.parquet(f"{out}/found=-1")
        at_once = max(1, VISIT_CELLS // len(self.book.centers))
        number = 0
        for group in question_groups(asked, query_col, MAX_QUERY_CELLS):
            for start in range(0, group.num_rows, at_once):
                self._scan(group.slice(start, at_once), k, probe, rescored, query_col, schema, max_queries).write.parquet(f"{out}/found={number}")
                number += 1
        found = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out)
        ranked = Window.partitionBy(query_col).orderBy(F.col("score").desc(), self.id_col)
        return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select(query_col, "rank", self.id_col, "score")

    def _scan(self, asked: pa.Table, k: int, probe: int, rescored: int, query_col: str, schema: T.StructType, step: int) -> DataFrame:
        """The k best of each piece of the index that a task holds at a time, for questions of a bounded matrix."""
        spark, book = self.table.sparkSession, self.book
        matrix = QueryMatrix.of(asked, query_col, "cosine")
        visits = None if probe == len(book.centers) else _visits(matrix.vectors.T, book.centers, probe)
        shared = spark.sparkContext.broadcast((matrix, visits, book))
        id_col, wanted, names = self.id_col, rescored * k, _arrow_schema(schema)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matrix, visits, book = shared.value
            units = np.ascontiguousarray(matrix.vectors.T)
            for table in _held(batches, max(1, HELD_CELLS // max(1, units.shape[1]))):
                held = _Held(table, id_col, book)
                block = max(1, min(step, SCORE_CELLS // table.num_rows))
                for start in range(0, len(units), block):
                    some = slice(start, start + block)
                    q, rows, exact = held.best(units[some], None if visits is None else visits[some], wanted, k)
                    if len(q):
                        asking = pa.array(matrix.ids[start + q].tolist(), names.field(0).type)
                        found = pc.cast(table.column(id_col).take(pa.array(rows)).combine_chunks(), names.field(1).type)
                        yield pa.RecordBatch.from_arrays([asking, found, pa.array(exact)], schema=names)

        probed = self.table
        if visits is not None:
            probed = probed.filter(F.col("list").isin(np.flatnonzero(visits.any(axis=0)).tolist()))
        return probed.select(id_col, "list", "codes", "norm", "embedding").mapInArrow(scan, schema)


def _visits(units: np.ndarray, centers: np.ndarray, probe: int) -> np.ndarray:
    """Which lists each question looks into: the nearest ones, told for a bounded number of questions at a time."""
    visits = np.zeros((len(units), len(centers)), bool)
    half, step = (centers**2).sum(axis=1) / 2, max(1, SCORE_CELLS // len(centers))
    for start in range(0, len(units), step):
        farness = half - units[start : start + step] @ centers.T
        np.put_along_axis(visits[start : start + step], np.argpartition(farness, probe - 1, axis=1)[:, :probe], True, axis=1)
    return visits


def _held(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches together, until they have so many rows."""
    waiting, n = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(waiting)
            waiting, n = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


class _Held:
    """Rows of the index that a task works on: what their codes stand for, as long as their scores ask, and whole vectors."""

    def __init__(self, table: pa.Table, id_col: str, book: Codebook):
        table = table.combine_chunks()
        lists = table.column("list").to_numpy()
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.uint8).reshape(table.num_rows, -1)
        self.coded = (book.decode(lists, codes) / table.column("norm").to_numpy()[:, None]).astype(np.float32)
        self.whole = _matrix(table.column("embedding").combine_chunks(), "cosine")
        self.places = pc.rank(table.column(id_col), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False)
        # rows of one list lie together
        ends = np.flatnonzero(np.diff(lists)) + 1
        self.runs = [(int(lists[a]), slice(a, b)) for a, b in zip(np.r_[0, ends].tolist(), np.r_[ends, len(lists)].tolist())]

    def best(self, units: np.ndarray, visits: np.ndarray | None, wanted: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Question, row and exact score of the k best of each question's ``wanted`` best codes; equal scores by id."""
        n, asking = len(self.coded), units.astype(np.float32)
        if visits is None:
            scores = asking @ self.coded.T
        else:
            scores = np.full((len(units), n), -np.inf, np.float32)
            for where, run in self.runs:
                visitors = np.flatnonzero(visits[:, where])
                if len(visitors):
                    scores[visitors, run] = asking[visitors] @ self.coded[run].T
        if n > wanted:
            rows = np.argpartition(scores, n - wanted, axis=1)[:, n - wanted :]
        else:
            rows = np.broadcast_to(np.arange(n), scores.shape)
        if n <= DENSE_SHARE * wanted:  # all products are sooner made than few are gathered
            exact = np.take_along_axis(units @ self.whole.T, rows, axis=1)
        else:
            exact = np.empty(rows.shape)
            step = max(1, SCORE_CELLS // (rows.shape[1] * units.shape[1]))
            for at in range(0, len(units), step):
                some = slice(at, at + step)
                exact[some] = np.matmul(self.whole[rows[some]], units[some, :, None])[:, :, 0]
        exact = np.round(exact, 6) + 0.0
        if visits is not None:
            exact[np.isneginf(np.take_along_axis(scores, rows, axis=1))] = -np.inf
        last = max(0, rows.shape[1] - k)
        least = np.partition(exact, last, axis=1)[:, last]
        q, at = np.nonzero((exact >= least[:, None]) & (exact > -np.inf))
        found, score = rows[q, at], exact[q, at]
        order, place = _places(q, -score, self.places[found])
        order = order[place < k]
        return q[order], found[order], score[order]


def _places(q: np.ndarray, *by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of question and ``by``, and the place of each among its question's."""
    order = np.lexsort((*by[::-1], q))
    ordered = q[order]
    starts = np.r_[0, np.flatnonzero(np.diff(ordered)) + 1] if len(q) else np.zeros(0, np.int64)
    return order, np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))


def build_coded(vectors: DataFrame, path: str, id_col: str = "chunk_id", n_lists: int | None = None, sample: int = SAMPLE, seed: int = 0) -> CodedIndex:
    """Fit a codebook on at most ``sample`` vectors and code all of ``vectors`` (``id_col, embedding``).

    Vectors are scaled to unit length. Null, empty and not finite vectors, zero
    ones, and those of another length than most have are left out; rows may
    repeat. The table is sorted by list, so that a search reads the lists it
    probes; a list of any size is spread over files. An empty table gives an
    index that finds nothing.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    dim = usual_length(vectors)
    usable = vectors.select(id_col, "embedding").filter(finite("embedding") & (F.size("embedding") == dim) & F.exists("embedding", lambda x: x != 0))
    n = usable.count()
    drawn = usable
    if n > sample:  # by hash, somewhat more than wanted, so that no sort of all rows is needed
        drawn = usable.filter(F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(1_000_000)) < min(1_000_000, int(1.2e6 * sample / n) + 1))
    fitted = drawn.limit(sample).select("embedding").toArrow()
    rows = _matrix(fitted.column("embedding").combine_chunks(), "cosine") if n else np.zeros((0, max(dim, 1)))
    book = Codebook.fit(rows, n_lists or int(np.clip(np.sqrt(n), MIN_LISTS, MAX_LISTS)), seed) if n else Codebook(np.zeros((1, 1)), np.zeros((1, ENTRIES, 1)))
    shared = spark.sparkContext.broadcast(book)
    schema = T.StructType(
        [*usable.schema.fields, T.StructField("list", T.IntegerType()), T.StructField("codes", T.BinaryType()), T.StructField("norm", T.DoubleType())]
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            made = shared.value
            lists, codes = made.code(_matrix(batch.column("embedding"), "cosine"))
            # the coded vector's own length: scores are products with vectors of length one
            back = made.decode(lists, codes)
            norms = np.sqrt((back * back).sum(axis=1))
            columns = [pa.array(lists.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(np.where(norms > 0, norms, 1.0))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema.names)

    # a file is read by one task
    files = max(1, -(-n // FILE_ROWS), min(spark.sparkContext.defaultParallelism, n // MIN_FILE_ROWS))
    spread = usable.mapInArrow(code, schema).repartitionByRange(files, "list", F.xxhash64(id_col)).sortWithinPartitions("list")
    spread.write.parquet(f"{path}/coded")
    said = {"id_col": id_col, "dim": dim, "centers": book.centers.tolist(), "entries": book.entries.tolist()}
    spark.createDataFrame([(json.dumps(said),)], "book string").coalesce(1).write.parquet(f"{path}/book")
    return open_coded(spark, path)


def open_coded(spark: SparkSession, path: str) -> CodedIndex:
    """A written index of codes."""
    said = json.loads(spark.read.parquet(f"{path}/book").first()["book"])
    book = Codebook(np.array(said["centers"]), np.array(said["entries"]))
    return CodedIndex(path, spark.read.parquet(f"{path}/coded"), book, said["id_col"], said["dim"])


def recall(found: DataFrame, exact: DataFrame, query_col: str = "query_id", id_col: str = "chunk_id") -> DataFrame:
    """Per question how many exact hits there are, and how many of them were found.

    A hit that ties with the last exact one counts as well as that.
    """
    last = exact.groupBy(query_col).agg(F.count("*").alias("n_exact"), F.min("score").alias("_last"))
    good = found.join(last, query_col, "right").withColumn("_hit", (F.col("score") >= F.col("_last")).cast("int"))
    return good.groupBy(query_col).agg(F.first("n_exact").alias("n_exact"), F.least(F.first("n_exact"), F.coalesce(F.sum("_hit"), F.lit(0))).alias("n_found"))
