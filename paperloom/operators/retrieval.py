"""Retrieval over an index: semantic, hybrid, reranked, pruned."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from paperloom.functions.policy import Policy, mask_pii, plain_terms
from paperloom.functions.text import terms
from paperloom.operators.embedding import MAX_BROADCAST_TERMS, join_term_table
from paperloom.operators.ingest import Index, block_of, bm25_weight, part_of, posted
from paperloom.operators.screening import apply_policy
from paperloom.operators.search import MAX_QUERIES, MAX_QUERY_CELLS, QueryMatrix, _scan, finite, question_blocks, top_k
from paperloom.staging import broadcast_if_small, fits, scratch_path, stage

# Largest hit table sent to the chunk scan; larger ones are shuffled.
MAX_BROADCAST_HITS = 500_000
# Vectors of a cell in one file, and tasks that write cells at most.
CELL_ROWS = 100_000
MAX_CELL_TASKS = 10_000
# Postings of the asked terms that are read without looking which of them can matter.
DIRECT_POSTINGS = 20_000_000
# From so many postings, and such a share of all words, the terms of the chunks are read in their place.
SCAN_POSTINGS = 1_000_000
SCAN_SHARE = 0.125
# Postings of a question's rarest terms, for each hit wanted, that tell what others must beat.
FIRST_POSTINGS = 50
# Scores are rounded; a block this far below still counts.
SLACK = 1e-6
FUSION_OFFSET = 60
# Pairs of question and text that a model scores at a time.
SCORED = 256
CANDIDATES = 10


def with_texts(hits: DataFrame, index: Index) -> DataFrame:
    """Hits with the text of their chunk; only the parts that hold one are read."""
    hits = stage(hits, "asked-for")
    parts = [r["p"] for r in hits.select(part_of("chunk_id", index.parts).alias("p")).distinct().collect()]
    there = index.chunks.filter(F.col("part").isin(parts) if parts else F.lit(False)).select("chunk_id", "text")
    return there.join(broadcast_if_small(hits, MAX_BROADCAST_HITS), "chunk_id")


def retrieve(questions: DataFrame, index: Index, k: int = 3, where: Column | None = None) -> DataFrame:
    """``(query_id, rank, chunk_id, score)``, the k best chunks by cosine.

    ``where`` filters on metadata columns before anything is scored. A chunk
    sharing no term with the question is no hit; with a model's vectors the k
    nearest are hits whatever their score.
    """
    vectors = index.vectors if where is None else index.vectors.filter(where)
    return _nearest(vectors, questions, index, k)


def _nearest(vectors: DataFrame, questions: DataFrame, index: Index, k: int, **of: object) -> DataFrame:
    asked = index.embed_questions(questions)
    if index.make_model is not None:
        return top_k(vectors, asked, k, "cosine", **of)
    return top_k(vectors, asked, k, "dot", min_score=0.0, **of)


def retrieve_parents(questions: DataFrame, index: Index, k: int = 3) -> DataFrame:
    """The k best parents ``(query_id, rank, parent_id, score)`` of an index
    of hierarchical chunks; a parent scores as its best child.

    One reading of the vectors: a task keeps its k best parents of a question,
    however many children a parent has.
    """
    vectors = index.vectors.withColumn("parent_id", F.substring_index("chunk_id", "#", 2))
    return _nearest(vectors, questions, index, k, id_col="parent_id", distinct=True)


def retrieve_one(index: Index, question: str, k: int = 3) -> DataFrame:
    """V5: the k best chunks for one question, best first."""
    asked = index.chunks.sparkSession.createDataFrame([(0, question)], "query_id long, question string")
    return retrieve(asked, index, k).orderBy(F.col("score").desc(), "chunk_id").limit(k)


def retrieve_lexical(questions: DataFrame, index: Index, k: int, direct: int = DIRECT_POSTINGS) -> DataFrame:
    """BM25: chunk and question as vectors over the terms of the questions.

    Reads the postings of those terms, in the parts that hold one; no text.
    Beyond ``direct`` postings only blocks are read that can hold one of a
    question's k best, see ``_needed_blocks``. Where the postings to read are
    many and a good share of all, the terms of the chunks (of those blocks) are
    read instead: they need no shuffle. The hits are the same.
    """
    asked = questions.select("query_id", F.explode(F.array_distinct(terms("question"))).alias("term"))
    vocabulary = stage(
        index.terms.join(asked.select("term").distinct(), "term", "left_semi")
        .withColumns({"bucket": F.monotonically_increasing_id(), "part": part_of("term", index.term_parts or index.parts)}),
        "vocabulary",
    )
    known = vocabulary.groupBy("part").agg(F.sum("df").alias("df")).collect()
    here = F.col("part").isin([r["part"] for r in known]) if known else F.lit(False)
    postings, chunks, to_read = index.postings, index.counts, sum(r["df"] for r in known)
    wanted = vocabulary.select("term", "df", "bucket")
    held = fits(wanted, MAX_BROADCAST_TERMS)
    if index.blocks is not None and to_read > direct:
        needed = _needed_blocks(index.blocks.filter(here), asked.join(vocabulary, "term"), index, k)
        postings = posted(needed)
        if held and _many(to_read, index):
            found = needed.join(F.broadcast(wanted.select("term")), "term", "left_semi")
            sizes = stage(found.groupBy("block").agg(F.sum(F.size("entries")).alias("n")), "needed-sizes")
            to_read = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            if index.n_blocks:
                own = chunks.withColumn("block", block_of("chunk_id", index.parts, index.n_blocks))
                chunks = own.join(broadcast_if_small(sizes.select("block"), MAX_BROADCAST_TERMS), "block", "left_semi")
    if held and _many(to_read, index):
        chunk_vectors = _term_weights(chunks, index, wanted)
    else:
        postings = postings.filter(here).drop("part")
        found = postings.join(F.broadcast(wanted), "term") if held else join_term_table(postings, wanted, index.n_chunks)
        weight = bm25_weight(F.col("tf"), F.col("n"), index.mean_terms)
        # a chunk has as many entries at most as it has terms
        gathered = found.select("chunk_id", F.struct("bucket", weight.alias("weight")).alias("_v")).groupBy("chunk_id").agg(F.collect_list("_v").alias("_v"))
        chunk_vectors = gathered.select("chunk_id", F.col("_v.bucket").alias("buckets"), F.col("_v.weight").alias("weights"))
    question_vectors = (
        asked.join(vocabulary, "term")
        .groupBy("query_id")
        .agg(F.collect_list(F.struct("bucket", "idf")).alias("_v"))
        .select("query_id", F.col("_v.bucket").alias("buckets"), F.col("_v.idf").alias("weights"))
    )
    return top_k(chunk_vectors, question_vectors, k, "dot", min_score=0.0)


def _many(postings: int, index: Index) -> bool:
    """Whether to shuffle so many postings costs more than to read the terms of all chunks."""
    return postings > SCAN_POSTINGS and postings > SCAN_SHARE * index.n_chunks * index.mean_terms


def _term_weights(counts: DataFrame, index: Index, wanted: DataFrame) -> DataFrame:
    """``(chunk_id, buckets, weights)`` of chunks with a wanted term, made where their counts are read.

    Only rows of an id that several chunks have are brought together.
    """
    table = wanted.select("term", "bucket").toArrow().combine_chunks()
    shared = counts.sparkSession.sparkContext.broadcast((table.column("term").combine_chunks(), table.column("bucket").to_numpy()))
    mean = index.mean_terms
    schema = T.StructType(
        [counts.schema["chunk_id"], T.StructField("buckets", T.ArrayType(T.LongType())), T.StructField("weights", T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, buckets = shared.value
        for batch in batches:
            lists = batch.column("terms")
            found = pc.index_in(pc.list_flatten(lists), value_set=names)
            here = found.is_valid()
            row = pc.list_parent_indices(lists).filter(here).to_numpy(zero_copy_only=False)
            tf = pc.list_flatten(batch.column("tfs")).filter(here).to_numpy(zero_copy_only=False)
            weights = bm25_weight(tf, batch.column("n").to_numpy(zero_copy_only=False)[row], mean)
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v)) for v in (buckets[found.drop_null().to_numpy(zero_copy_only=False)], weights)]
            yield pa.RecordBatch.from_arrays([batch.column("chunk_id"), *made], schema.names).filter(pa.array(np.diff(offsets) > 0))

    weighed = lambda rows: rows.select("chunk_id", "n", "terms", "tfs").mapInArrow(run, schema)
    ids = index.counts.groupBy("chunk_id").agg(F.count("*").alias("_n"))
    several = stage(ids.filter("_n > 1").select(F.col("chunk_id").alias("_id")), "several")
    if several.isEmpty():
        return weighed(counts)
    several, same = broadcast_if_small(several, MAX_BROADCAST_HITS), F.col("chunk_id").eqNullSafe(F.col("_id"))
    together = weighed(index.counts.join(several, same, "left_semi")).groupBy("chunk_id")
    together = together.agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("buckets", "weights")))
    return weighed(counts.join(several, same, "left_anti")).unionByName(together)


def _needed_blocks(blocks: DataFrame, asked: DataFrame, index: Index, k: int) -> DataFrame:
    """The blocks that can hold one of the k best chunks of a question; ``asked`` has ``query_id, term, df, idf``.

    The postings of a question's rarest terms, a bounded number, give parts of
    scores; the k-th of them is less than the k-th score. A block of chunks
    cannot beat that if the largest weights its postings have for all of the
    question's terms, added up, do not. Only those weights are read to tell.
    Where the terms and blocks that are left are too many for the tasks to
    hold, all terms of these blocks are read: the postings are never shuffled.
    """
    rarest = Window.partitionBy("query_id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, 0)
    asked = stage(asked.select("query_id", "term", "df", "idf").withColumn("_upto", F.sum("df").over(rarest)), "asked")
    first = asked.filter(F.col("_upto") <= FIRST_POSTINGS * k).select("query_id", "term", "idf")
    met = posted(blocks).join(broadcast_if_small(first, MAX_BROADCAST_TERMS), "term")
    part = F.sum(F.col("idf") * bm25_weight(F.col("tf"), F.col("n"), index.mean_terms))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc())
    partly = met.groupBy("query_id", "chunk_id").agg(part.alias("score")).withColumn("_r", F.row_number().over(best))
    reached = partly.filter(F.col("_r") == k).select("query_id", F.col("score").alias("_least"))
    asked_terms = broadcast_if_small(asked.select("query_id", "term", "idf"), MAX_BROADCAST_TERMS)
    bounds = blocks.select("term", "block", "top").join(asked_terms, "term").groupBy("query_id", "block").agg(F.sum(F.col("idf") * F.col("top")).alias("_bound"))
    open_pairs = bounds.join(broadcast_if_small(reached, MAX_BROADCAST_TERMS), "query_id", "left").filter(F.col("_bound") >= F.coalesce("_least", F.lit(0.0)) - SLACK)
    open_pairs = stage(open_pairs.select("query_id", "block"), "open")
    sizes = open_pairs.groupBy("query_id").agg(F.count("*").alias("_n")).join(asked.select("query_id"), "query_id")
    if sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0] > MAX_BROADCAST_TERMS:
        return blocks.join(broadcast_if_small(stage(open_pairs.select("block").distinct(), "needed"), MAX_BROADCAST_TERMS), "block", "left_semi").select(*blocks.columns)
    needed = stage(open_pairs.join(asked.select("query_id", "term"), "query_id").select("term", "block").distinct(), "needed")
    return blocks.join(broadcast_if_small(needed, MAX_BROADCAST_TERMS), ["term", "block"], "left_semi")


def fuse(rankings: list[DataFrame], k: int) -> DataFrame:
    """Reciprocal-rank fusion of several hit tables."""
    union = rankings[0].select("query_id", "chunk_id", "rank")
    for other in rankings[1:]:
        union = union.unionByName(other.select("query_id", "chunk_id", "rank"))
    fused = union.groupBy("query_id", "chunk_id").agg(F.round(F.sum(1 / (F.lit(FUSION_OFFSET) + F.col("rank"))), 6).alias("score"))
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "chunk_id")
    return fused.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", "chunk_id", "score")


def retrieve_hybrid(questions: DataFrame, index: Index, k: int = 3) -> DataFrame:
    """R2: semantic and lexical candidates, fused by rank."""
    return fuse([retrieve(questions, index, CANDIDATES * k), retrieve_lexical(questions, index, CANDIDATES * k)], k)


def overlap(question: Column, text: Column) -> Column:
    """Share of the question's distinct terms that the text has."""
    asked = F.array_distinct(terms(question))
    return F.when(F.size(asked) > 0, F.size(F.array_intersect(asked, F.array_distinct(terms(text)))) / F.size(asked)).otherwise(0.0)


def rerank(
    candidates: DataFrame,
    k: int = 3,
    scorer: Callable[[str, str], float] | None = None,
    make_scorer: Callable[[], Callable[[list[str], list[str]], list[float]]] | None = None,
) -> DataFrame:
    """Candidates ``(query_id, question, chunk_id, text)`` scored again.

    Scores by term overlap, by ``scorer(question, text)``, or by a model:
    ``make_scorer()`` is called once in a task and what it returns gets up to
    ``SCORED`` questions with their texts at a time. A pair with a null side is
    not handed over and scores 0.
    """
    if make_scorer is None and scorer is not None:
        make_scorer = partial(_by_pair, scorer)
    score = overlap(F.col("question"), F.col("text")) if make_scorer is None else _modelled(make_scorer)("question", "text")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "chunk_id")
    return candidates.withColumn("score", F.round(score, 6)).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def _by_pair(scorer: Callable[[str, str], float]) -> Callable[[list[str], list[str]], list[float]]:
    return lambda questions, texts: [scorer(q, t) for q, t in zip(questions, texts)]


def _modelled(make_scorer: Callable[[], Callable[[list[str], list[str]], list[float]]]) -> Callable[..., Column]:
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = make_scorer()
        for question, text in batches:
            scores = np.zeros(len(text))
            known = np.flatnonzero((question.notna() & text.notna()).to_numpy())
            for start in range(0, len(known), SCORED):
                at = known[start : start + SCORED]
                made = model(question.iloc[at].tolist(), text.iloc[at].tolist())
                if len(made) != len(at):
                    raise ValueError(f"{len(made)} scores for {len(at)} pairs")
                scores[at] = made
            yield pd.Series(scores)

    return F.pandas_udf(apply, T.DoubleType())


def make_term_scorer() -> Callable[[list[str], list[str]], list[float]]:
    """A stand-in for a model: the share of a question's distinct terms that the text contains, be it inside a word."""

    def score(questions: list[str], texts: list[str]) -> list[float]:
        made = []
        for question, text in zip(questions, texts):
            asked, low = set(plain_terms(question)), text.lower()
            made.append(sum(t in low for t in asked) / len(asked) if asked else 0.0)
        return made

    return score


def retrieve_guarded(questions: DataFrame, index: Index, k: int = 3, policy: Policy | None = None) -> DataFrame:
    """K9: blocked questions find nothing; personal data in hits is masked."""
    screened = apply_policy(questions, policy, "input", "question").filter(F.col("action") != "blocked")
    hits = stage(retrieve(screened, index, k), "hits")
    return with_texts(hits, index).withColumn("text", mask_pii(F.col("text"), policy))


class Cells:
    """Vectors grouped by nearest center, for pruned exact search.

    Centers are vectors of the table itself, and vectors of another length than
    most have are left out. Each cell knows its radius, so the
    triangle inequality tells which cells cannot hold a better neighbour; they
    are partitions of the written table and are not read.
    """

    def __init__(self, table: DataFrame, centers: np.ndarray, radius: np.ndarray, id_col: str, metric: str):
        self.table, self.centers, self.radius, self.id_col, self.metric = table, centers, radius, id_col, metric
        # of the last block: cells read, and pairs of question and cell, first probed and then needed
        self.last_read: list[list[int]] = []
        self.last_pairs: tuple[int, int] = (0, 0)

    @classmethod
    def build(cls, vectors: DataFrame, path: str, n_cells: int = 64, id_col: str = "chunk_id", metric: str = "cosine", cell_rows: int = CELL_ROWS) -> "Cells":
        if metric not in ("cosine", "euclidean"):
            raise ValueError(f"cells serve cosine and euclidean, not {metric}")
        dim = usual_length(vectors)
        vectors = vectors.filter(F.size("embedding") == dim)
        sample = vectors.filter(finite("embedding")).orderBy(F.xxhash64(id_col), id_col).limit(n_cells).select("embedding").toArrow()
        centers = _matrix(sample.column("embedding").combine_chunks(), metric)
        spark = vectors.sparkSession
        shared = spark.sparkContext.broadcast(centers)
        schema = T.StructType(
            [*vectors.select(id_col, "embedding").schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())]
        )

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                distance = _distances(_matrix(batch.column("embedding"), metric), shared.value)
                cell = distance.argmin(axis=1).astype(np.int32) if batch.num_rows else np.zeros(0, np.int32)
                far = distance[np.arange(len(cell)), cell] if batch.num_rows else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], schema.names)

        placed = vectors.select(id_col, "embedding").filter(finite("embedding")).mapInArrow(assign, schema)
        # one row per cell: how full it is tells over how many tasks and files it is spread
        radius, files = np.full(len(centers), -1.0), np.ones(len(centers), int)
        for row in placed.groupBy("cell").agg(F.max("far").alias("r"), F.count("*").alias("n")).collect():
            radius[row["cell"]], files[row["cell"]] = row["r"], -(-row["n"] // cell_rows)
        pieces = F.element_at(F.array(*[F.lit(int(n)) for n in files]), F.col("cell") + 1)
        spread = placed.repartition(int(min(files.sum(), MAX_CELL_TASKS)), F.col("cell"), F.pmod(F.xxhash64(id_col), pieces))
        spread.write.partitionBy("cell").parquet(path)
        table = spark.read.parquet(path)
        return cls(table, centers, radius, id_col, metric)

    @property
    def dim(self) -> int:
        return self.centers.shape[1]

    def search(
        self, queries: DataFrame, k: int = 3, n_probe: int = 4, query_col: str = "query_id", max_queries: int = MAX_QUERIES, max_cells: int = MAX_QUERY_CELLS
    ) -> DataFrame:
        """The exact k nearest: each question reads its probed cells and those that may matter to it.

        Questions come in blocks of bounded size, each pruned on its own. One
        whose vector has not the length of the index's finds nothing.
        """
        asked = queries.select(query_col, "embedding").filter(finite("embedding") & (F.size("embedding") == self.dim))
        schema = T.StructType([asked.schema[query_col], self.table.schema[self.id_col], T.StructField("score", T.DoubleType())])
        spark, out = self.table.sparkSession, scratch_path(self.table.sparkSession, "cells")
        spark.createDataFrame([], schema).write.parquet(f"{out}/found=-1")
        for number, block in enumerate(question_blocks(asked, query_col, max_queries, max_cells)):
            self._search_block(block, k, n_probe, query_col, schema, f"{out}/found={number}")
        found = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out)
        return self._ranked(found, k, query_col)

    def _search_block(self, block: pa.Table, k: int, n_probe: int, query_col: str, schema: T.StructType, out: str) -> None:
        matrix = QueryMatrix.of(block, query_col, self.metric)
        to_centers = _distances(_matrix(block.column("embedding").combine_chunks(), self.metric), self.centers)
        filled = np.flatnonzero(self.radius >= 0)
        first = np.zeros(to_centers.shape, bool)
        np.put_along_axis(first, filled[np.argsort(to_centers[:, filled], axis=1)[:, :n_probe]], True, axis=1)
        self._within(first, matrix, k, schema).write.parquet(f"{out}/probed")
        probed = self.table.sparkSession.read.schema(schema).parquet(f"{out}/probed")
        # the k-th best distance so far bounds what other cells must beat
        kth = {r[0]: r[1] for r in self._ranked(probed, k, query_col).filter(F.col("rank") == k).select(query_col, "score").collect()}
        reach = np.array([self._distance(kth.get(q)) for q in block.column(query_col).to_pylist()])
        may = (to_centers - self.radius[None, :] <= reach[:, None]) & (self.radius >= 0)[None, :] & ~first
        self.last_read = [np.flatnonzero(first.any(axis=0)).tolist(), np.flatnonzero(may.any(axis=0)).tolist()]
        self.last_pairs = int(first.sum()), int(may.sum())
        if may.any():
            self._within(may, matrix, k, schema).write.parquet(f"{out}/others")

    def _within(self, visits: np.ndarray, matrix: QueryMatrix, k: int, schema: T.StructType) -> DataFrame:
        cells = np.flatnonzero(visits.any(axis=0)).tolist()
        lists = {c: np.flatnonzero(visits[:, c]) for c in cells}
        rows = self.table.filter(F.col("cell").isin(cells)).select(self.id_col, "embedding", "cell")
        return _scan(rows, matrix, k, self.id_col, None, schema, lists)

    def _ranked(self, found: DataFrame, k: int, query_col: str) -> DataFrame:
        order = F.col("score").asc() if self.metric == "euclidean" else F.col("score").desc()
        ranked = Window.partitionBy(query_col).orderBy(order, self.id_col)
        return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select(query_col, "rank", self.id_col, "score")

    def _distance(self, score: float | None) -> float:
        """A ranked score as Euclidean distance, widened by its rounding."""
        if score is None:
            return np.inf
        slack = 1e-6
        if self.metric == "euclidean":
            return score + slack
        return float(np.sqrt(max(0.0, 2 - 2 * (score - slack)))) + slack


def usual_length(vectors: DataFrame) -> int:
    """The length most finite vectors have (0 for an empty table); a row a length is all that is shuffled."""
    lengths = vectors.filter(finite("embedding")).groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    first = lengths.orderBy(F.col("n").desc(), "dim").first()
    return first["dim"] if first else 0


def _matrix(lists: pa.Array, metric: str) -> np.ndarray:
    values = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    if metric == "cosine":
        norms = np.sqrt((values * values).sum(axis=1, keepdims=True))
        values = values / np.where(norms > 0, norms, 1.0)
    return values


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0.0))
