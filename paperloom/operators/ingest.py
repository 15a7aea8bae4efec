"""Building, loading and refreshing an index.

An index is a folder of tables: ``chunks`` (texts, in parts by a hash of the
chunk id), ``counts`` (the terms of each chunk and how often, those of a part together in ``block_order``), ``blocks``
(postings of a term for some of the chunks and the largest weight among them; in
parts by a hash of the term), ``terms`` (idf) and ``vectors``; with an embedding model ``rejects`` lists the vectors that broke
the contract. Metadata columns are kept on chunks, counts and vectors, and
vectors may be partitioned by one of them, so a metadata filter prunes them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.text import terms
from paperloom.operators.chunking import chunk_fixed
from paperloom.operators.embedding import DIMENSION, counted_idf, embed, embed_counts, embed_hash, term_counts, validate_vectors
from paperloom.staging import held_setting, stage

# Parts of the chunk and posting tables: so many at least and at most, and documents in a file of one.
MIN_PARTS, MAX_PARTS = 8, 1024
PART_ROWS = 50_000
# Postings in a file, and those of one term in a file, about.
POSTING_FILE_ROWS = 1_000_000
TERM_FILE_ROWS = 10_000_000
# Folders of posting lists at most. A task writes to a file in each at once, so it holds so many row groups.
TERM_PARTS = 32
ROW_GROUP_BYTES = 16 << 20
# Files of fewer postings, on average, are made up to this number.
SMALL_FILE_ROWS, SMALL_FILES = 10_000, 4_096
# Chunks whose postings of a term share a block, on average.
BLOCK_CHUNKS = 512
BLOCK_RANGE = 1 << 24
# The usual settings of BM25.
BM25_K1 = 1.2
BM25_B = 0.75

Chunker = Callable[[DataFrame], DataFrame]
MakeModel = Callable[[], Callable[[list[str]], list[list[float]]]]


@dataclass(frozen=True)
class Index:
    path: str
    chunks: DataFrame
    counts: DataFrame
    postings: DataFrame
    terms: DataFrame
    vectors: DataFrame
    n_chunks: int
    mean_terms: float
    parts: int
    dim: int
    metadata: tuple[str, ...]
    partition_by: str | None
    make_model: MakeModel | None = None
    blocks: DataFrame | None = None  # ``postings`` as they are stored
    n_blocks: int = 0  # 0 if not known
    term_parts: int = 0  # parts of ``postings``; 0: as many as of the chunks

    @property
    def rejects(self) -> DataFrame:
        """Rows whose model vector broke the contract, with the ``fault``."""
        return self.chunks.sparkSession.read.parquet(f"{self.path}/rejects")

    def embed_questions(self, questions: DataFrame, query_col: str = "query_id", text: str = "question") -> DataFrame:
        """Questions in the vector space of the index; unknown terms drop out.

        With a model, a question whose vector breaks the contract drops out.
        """
        if self.make_model is not None:
            made = embed(questions.select(query_col, F.col(text).alias("text")), self.make_model).drop("text")
            return validate_vectors(made, self.dim)[0]
        own = questions.select(F.explode(F.array_distinct(terms(text))).alias("term")).distinct()
        return embed_hash(questions, [query_col], text, idf=self.terms.join(own, "term", "left_semi"), n_chunks=self.n_chunks)


def bm25_weight(tf: Column | np.ndarray, n: Column | np.ndarray, mean_terms: float) -> Column | np.ndarray:
    """What a term that occurs ``tf`` times among a chunk's ``n`` adds to a score, before its idf."""
    damp = BM25_K1 * (1 - BM25_B + BM25_B * n / mean_terms)
    return tf * (BM25_K1 + 1) / (tf + damp)


def part_of(key: str | Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def block_order(key: str) -> Column:
    """A number under ``BLOCK_RANGE`` that orders the chunks of a part by their blocks, however many these are."""
    return F.shiftrightunsigned(F.xxhash64(key), 40)


def block_of(key: str, parts: int, n_blocks: int) -> Column:
    """A chunk's block of ``n_blocks``, a multiple of the parts: each part has its own."""
    within = F.floor(block_order(key) * F.lit(n_blocks // parts) / F.lit(BLOCK_RANGE))
    return (part_of(key, parts) + F.lit(parts) * within).cast("int")


def parts_for(n_docs: int) -> tuple[int, int]:
    """Parts of a table, a bounded number of folders, and files in each, which grow with the documents."""
    parts = min(max(MIN_PARTS, -(-n_docs // PART_ROWS)), MAX_PARTS)
    return parts, max(1, -(-n_docs // (parts * PART_ROWS)))


def ingest(
    docs: DataFrame,
    path: str,
    metadata: tuple[str, ...] = (),
    partition_by: str | None = None,
    dim: int = DIMENSION,
    chunker: Chunker = chunk_fixed,
    make_model: MakeModel | None = None,
) -> Index:
    """Chunk, count, weigh and embed ``docs``; every table is written once.

    ``chunker`` is any of the chunking operators, with its settings bound. With
    ``make_model`` vectors are the model's, as 32-bit floats; those that are not
    ``dim`` finite numbers, or zero, go to ``rejects`` (E3).
    """
    cut = chunker(docs.select("doc_id", "text", *metadata))
    parts, files = parts_for(docs.count())
    _write_chunks(cut, path, parts, files)
    keep = ["chunk_id", "doc_id", *metadata]
    chunks = docs.sparkSession.read.parquet(f"{path}/chunks")
    ordered = chunks.select(*keep, "text").sortWithinPartitions(block_order("chunk_id"))
    term_counts(ordered, keep).write.parquet(f"{path}/counts")
    if make_model is not None:
        _write_model_vectors(chunks.select(*keep, "text"), path, make_model, dim, partition_by)
    return _finish(docs.sparkSession, path, metadata, partition_by, dim, parts, make_model)


def _write_chunks(cut: DataFrame, path: str, parts: int, files: int) -> None:
    """A file's chunks lie in order of ids, so that ids prune parts and row groups."""
    placed = cut.withColumn("part", part_of("chunk_id", parts))
    placed.repartition(parts * files, *_file_keys(parts, files)).sortWithinPartitions("part", "chunk_id").write.partitionBy("part").parquet(f"{path}/chunks")


def _file_keys(parts: int, files: int) -> list[Column]:
    """What the chunks of a file have in common."""
    part = part_of("chunk_id", parts)
    return [part] if files == 1 else [part, F.pmod(F.hash("chunk_id"), F.lit(files))]


def _write_model_vectors(chunks: DataFrame, path: str, make_model: MakeModel, dim: int, partition_by: str | None, kept: DataFrame | None = None) -> None:
    made = stage(embed(chunks, make_model).drop("text"), "embedded")  # the model is asked once
    good, bad = validate_vectors(made, dim)
    vectors = good if kept is None else kept.select(*good.columns).unionByName(good)
    vectors.write.partitionBy(*([partition_by] if partition_by else [])).parquet(f"{path}/vectors")
    bad.write.parquet(f"{path}/rejects")


def _finish(
    spark: SparkSession, path: str, metadata: tuple[str, ...], partition_by: str | None, dim: int, parts: int, make_model: MakeModel | None
) -> Index:
    """What follows from the counts: weights, vectors, postings, and the index's own figures."""
    counts = spark.read.parquet(f"{path}/counts")
    n_chunks, mean, n_postings = counts.agg(F.count("*"), F.coalesce(F.avg("n"), F.lit(0.0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    counted_idf(counts, n_chunks).write.parquet(f"{path}/terms")
    if make_model is None:
        idf = spark.read.parquet(f"{path}/terms")
        vectors = embed_counts(counts, ["chunk_id", "doc_id", *metadata], dim, idf, n_chunks, own=True)
        vectors.write.partitionBy(*([partition_by] if partition_by else [])).parquet(f"{path}/vectors")
    # the list of a frequent term is as long as the index: it is cut into blocks
    n_blocks, term_parts = parts * max(1, n_chunks // (parts * BLOCK_CHUNKS)), min(parts, TERM_PARTS)
    listed = _listed(counts, parts, n_blocks, float(mean) or 1.0).withColumn("part", part_of("term", term_parts))
    if counts.rdd.getNumPartitions() * term_parts > max(SMALL_FILES, n_postings // SMALL_FILE_ROWS):
        files = max(1, n_postings // (term_parts * POSTING_FILE_ROWS), n_chunks // TERM_FILE_ROWS)
        listed = listed.repartition(4 * term_parts * files, "part", F.pmod("block", F.lit(files)))
    # lists go to the files of their parts as they are made: sorting them first would spill most. Writers as many as
    # the setting make Spark sort, so it is one more
    with held_setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(term_parts + 1)):
        listed.write.partitionBy("part").option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{path}/blocks")
    figures = [(n_chunks, float(mean), parts, dim, list(metadata), partition_by, n_blocks, term_parts)]
    spark.createDataFrame(
        figures, "n_chunks bigint, mean_terms double, parts int, dim int, metadata array<string>, partition_by string, n_blocks int, term_parts int"
    ).coalesce(1).write.parquet(f"{path}/figures")
    return load_index(spark, path, make_model)


def block_lists(counts: DataFrame, parts: int, n_blocks: int, mean_terms: float) -> DataFrame:
    """``(term, block, top, chunk_id, tf, n)``: the postings of a term for the chunks of a block as
    lists, and their largest weight.

    Lists are made in the task that reads the counts and written by it: postings
    are not shuffled. Counts lie in ``block_order``; a block that is read
    in pieces has a list for each.
    """
    listed = _listed(counts, parts, n_blocks, mean_terms)
    return listed.select("term", "block", "top", *(F.col("entries")[c].alias(c) for c in ("chunk_id", "tf", "n")))


def _listed(counts: DataFrame, parts: int, n_blocks: int, mean_terms: float) -> DataFrame:
    """``block_lists`` with the lists as one, ``entries``, as they are written."""
    placed = counts.select(block_of("chunk_id", parts, n_blocks).alias("block"), "chunk_id", "n", "terms", "tfs")
    chunk_id = placed.schema["chunk_id"].dataType
    schema = T.StructType(
        [
            T.StructField("term", T.StringType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("top", T.DoubleType()),
            T.StructField("entries", T.ArrayType(T.StructType([T.StructField("chunk_id", chunk_id), *(T.StructField(c, T.IntegerType()) for c in ("tf", "n"))]))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy(zero_copy_only=False)
            lengths = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False)
            edges = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(block)]
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                part = batch.slice(start, end - start)
                coded = pc.list_flatten(part.column("terms")).dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                if not len(codes):
                    continue
                order = np.argsort(codes, kind="stable")
                offsets = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1)).astype(np.int32)
                row = np.repeat(np.arange(end - start), lengths[start:end])[order]
                tf = pc.list_flatten(part.column("tfs")).to_numpy(zero_copy_only=False)[order]
                n = part.column("n").to_numpy(zero_copy_only=False)[row]
                top = np.maximum.reduceat(bm25_weight(tf, n, mean_terms), offsets[:-1])
                entries = pa.StructArray.from_arrays([part.column("chunk_id").take(pa.array(row)), pa.array(tf), pa.array(n)], ["chunk_id", "tf", "n"])
                own = pa.array(np.full(len(top), block[start], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([coded.dictionary, own, pa.array(top), pa.ListArray.from_arrays(pa.array(offsets), entries)], schema.names)

    return placed.mapInArrow(run, schema)


def load_index(spark: SparkSession, path: str, make_model: MakeModel | None = None) -> Index:
    """A written index; one built with a model is asked with the same model."""
    own = spark.read.parquet(f"{path}/figures").first()
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in ("chunks", "counts", "blocks", "terms", "vectors")}
    tables["postings"] = posted(tables["blocks"])
    modelled = "embedding" in tables["vectors"].columns
    if modelled != (make_model is not None):
        raise ValueError("an index of model vectors is loaded with its model, and no other is")
    return Index(
        path, **tables, n_chunks=own["n_chunks"], mean_terms=own["mean_terms"], parts=own["parts"], dim=own["dim"],
        metadata=tuple(own["metadata"]), partition_by=own["partition_by"], make_model=make_model,
        n_blocks=own["n_blocks"] if "n_blocks" in own else 0, term_parts=own["term_parts"] if "term_parts" in own else 0,
    )


def posted(blocks: DataFrame) -> DataFrame:
    """Blocks as postings: ``term, chunk_id, tf, n, part``."""
    return blocks.select("term", F.explode("entries").alias("_e"), "part").select("term", "_e.chunk_id", "_e.tf", "_e.n", "part")


def text_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def diff_ingest(old: DataFrame, new: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, status)`` of every document of either side.

    Only keys and hashes are shuffled, never the texts.
    """
    there = lambda df, name: df.select(key, F.struct(text_hash(F.col(text)).alias("hash")).alias(name))
    before, after = there(old, "_old"), there(new, "_new")
    # the struct tells a null text from no document
    status = (
        F.when(F.col("_old").isNull(), "new")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old.hash").eqNullSafe(F.col("_new.hash")), "unchanged")
        .otherwise("changed")
    )
    return before.join(after, key, "full_outer").select(key, status.alias("status"))


def to_rebuild(new: DataFrame, diff: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents whose chunks must be made again."""
    return new.join(diff.filter(F.col("status").isin("new", "changed")).select(key), key, "left_semi")


def refresh_chunks(
    chunks: DataFrame, new: DataFrame, diff: DataFrame, key: str = "doc_id", chunker: Callable[[DataFrame], DataFrame] = chunk_fixed
) -> DataFrame:
    """The chunk table of ``new``: kept chunks and those made again."""
    stale = diff.filter(F.col("status").isin("removed", "changed")).select(key)
    made = chunker(to_rebuild(new, diff, key))
    return chunks.select(*made.columns).join(stale, key, "left_anti").unionByName(made)


def refresh_index(
    index: Index, new: DataFrame, diff: DataFrame, path: str, key: str = "doc_id", chunker: Chunker = chunk_fixed
) -> Index:
    """The index of ``new``, written to ``path``; equal to one built anew.

    Only new and changed documents are chunked, counted and, with a model,
    embedded; the rest comes over from ``index``. Weights follow from all
    counts, so hashed vectors are weighed again, but no text is taken apart.
    ``diff`` compares texts: metadata of unchanged texts stays as it was.
    """
    spark = new.sparkSession
    diff = stage(diff, "diff")
    stale = diff.filter(F.col("status").isin("removed", "changed")).select(key)
    made = chunker(to_rebuild(new, diff, key).select("doc_id", "text", *index.metadata))
    kept = index.chunks.drop("part").join(stale, key, "left_anti")
    n_docs = diff.filter("status <> 'removed'").count()
    parts, files = parts_for(n_docs)
    made = stage(made, "made")
    _write_chunks(kept.select(*made.columns).unionByName(made), path, parts, files)
    keep = ["chunk_id", "doc_id", *index.metadata]
    counts = term_counts(made, keep)
    counts = index.counts.join(stale, key, "left_anti").select(*counts.columns).unionByName(counts)
    # in quarters of a part, which tasks can sort in memory
    quarter = block_of("chunk_id", parts, 4 * parts)
    counts.repartition(4 * parts * files, quarter, *_file_keys(parts, files)).sortWithinPartitions(block_order("chunk_id")).write.parquet(f"{path}/counts")
    if index.make_model is not None:
        still = index.vectors.join(stale, key, "left_anti")
        _write_model_vectors(made.select(*keep, "text"), path, index.make_model, index.dim, index.partition_by, still)
    return _finish(spark, path, index.metadata, index.partition_by, index.dim, parts, index.make_model)


def ingest_report(diff: DataFrame) -> DataFrame:
    """Documents by status."""
    return diff.groupBy("status").agg(F.count("*").alias("n_docs"))
