"""Embedding: hashed term vectors, injected models, the index contract."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.text import terms

DIMENSION = 1024
# Largest term table sent to every task; beyond it only frequent terms are.
MAX_BROADCAST_TERMS = 1_000_000
VECTOR_FIELDS = [T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("weights", T.ArrayType(T.FloatType()))]
# Terms that tasks hold by their hashes, 12 bytes each.
MAX_HELD_TERMS = 8_000_000
# Terms that tasks hold of a larger table: the most frequent ones.
KNOWN_TERMS = 200_000
# Rows whose terms are worked on at a time.
SLICE_ROWS = 2_000
# A term in more than this share of the chunks is "frequent".
FREQUENT_SHARE = 0.001


def term_bucket(term: Column, dim: int = DIMENSION) -> Column:
    hashed = F.conv(F.substring(F.md5(term.cast("binary")), 1, 8), 16, 10).cast("long")
    return (hashed % F.lit(dim)).cast("int")


def idf_value(n_chunks: int, df: Column) -> Column:
    return F.log(1 + (F.lit(float(n_chunks)) - df + 0.5) / (df + 0.5))


def term_idf(chunks: DataFrame, n_chunks: int, text: str = "text") -> DataFrame:
    """``(term, df, idf)`` over the chunks; counts are combined before the shuffle."""
    return (
        chunks.select(F.explode(F.array_distinct(terms(text))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
        .select("term", "df", idf_value(n_chunks, F.col("df")).alias("idf"))
    )


def join_term_table(occurrences: DataFrame, table: DataFrame, n_chunks: int) -> DataFrame:
    """Join term occurrences with a term table too large to broadcast.

    Its frequent part is broadcast: at most (terms per chunk) / FREQUENT_SHARE
    terms can each be in that share of the chunks, however large the corpus.
    What is left has no hot key and is joined by shuffle.
    """
    if n_chunks <= 0:
        raise ValueError("the number of chunks tells which terms are frequent")
    frequent = F.broadcast(table.filter(F.col("df") > n_chunks * FREQUENT_SHARE))
    rare = table.filter(F.col("df") <= n_chunks * FREQUENT_SHARE)
    return occurrences.join(frequent, "term").unionByName(
        occurrences.join(frequent.select("term"), "term", "left_anti").join(rare, "term")
    )


class Vocabulary:
    """A bounded term table inside a task: each term's bucket and weight."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.terms = table.column("term").combine_chunks()
        self.buckets, self.rank = np.unique(table.column("bucket").to_numpy(), return_inverse=True)
        self.weights = table.column("weight").to_numpy()

    def sums(self, lists: pa.Array, times: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per list the summed weight of each bucket: ``(offsets, buckets, sums)``.

        ``times`` says how often each term stands for itself. Terms outside the
        vocabulary are left out. All lists of a batch are handled together.
        """
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        found = pc.index_in(pc.list_flatten(lists), value_set=self.terms)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        at = found.drop_null().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists), dtype=np.int64), lengths)[known]
        key = row * max(1, len(self.buckets)) + self.rank[at]
        often = pc.list_flatten(times).to_numpy(zero_copy_only=False)[known]
        order = np.argsort(key, kind="stable")
        key, weights = key[order], (self.weights[at] * often)[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        sums = np.add.reduceat(weights, starts) if len(starts) else np.zeros(0)
        rows, ranks = np.divmod(key[starts], max(1, len(self.buckets)))
        return np.searchsorted(rows, np.arange(len(lists) + 1)).astype(np.int32), self.buckets[ranks], sums


def bounded_vocabulary(table: DataFrame) -> Vocabulary | None:
    """``(term, bucket, weight)`` for the tasks, or None beyond the bound."""
    found = table.select("term", F.col("bucket").cast("long").alias("bucket"), F.col("weight").cast("double").alias("weight"))
    found = found.limit(MAX_BROADCAST_TERMS + 1).toArrow()
    return Vocabulary(found) if found.num_rows <= MAX_BROADCAST_TERMS else None


class HeldTerms:
    """Weights of terms by 64 bits of their MD5, for many more terms than a ``Vocabulary`` has.

    A term that is not held weighs ``other``. Two of ten million terms have the
    same 64 bits with a chance of three in a million.
    """

    def __init__(self, table: pa.Table, dim: int, other: float):
        keys = table.column("key").to_numpy().astype(np.uint64)
        order = np.argsort(keys)
        self.keys, self.dim = keys[order], dim
        # weights follow from frequencies, of which there are few; the last is for terms that are not held
        values, rank = np.unique(table.column("weight").to_numpy(), return_inverse=True)
        self.values, self.rank = np.r_[values, other], rank[order].astype(np.uint32)

    def weights(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), self.values[-1])
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.values[np.where(self.keys[at] == keys, self.rank[at], len(self.values) - 1)]

    def sums(self, lists: pa.Array, times: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``Vocabulary.sums``; each term of a batch is looked up once."""
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        coded = pc.list_flatten(lists).dictionary_encode()
        keys, buckets = _digests(coded.dictionary, self.dim)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists), dtype=np.int64), lengths)
        often = pc.list_flatten(times).to_numpy(zero_copy_only=False)
        return _summed(row, buckets[codes], self.weights(keys)[codes] * often, len(lists))


def _digests(names: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each term the last 64 bits of its MD5, and the bucket that ``term_bucket`` makes of the first 32."""
    whole = b"".join([md5(t, usedforsecurity=False).digest() for t in names.cast(pa.binary()).to_pylist()])
    halves = np.frombuffer(whole, ">u8").astype(np.uint64).reshape(-1, 2)
    return halves[:, 1], ((halves[:, 0] >> np.uint64(32)) % np.uint64(dim)).astype(np.int64)


def held_terms(table: DataFrame, dim: int) -> HeldTerms | None:
    """``(term, df, weight)`` of all terms of some rows for the tasks, or None beyond the bound.

    What is in one row only is not held: these terms, the most, all weigh the same.
    """
    several = table.filter(F.col("df") > 1)
    if several.count() > MAX_HELD_TERMS:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array(_digests(batch.column("term"), dim)[0].view(np.int64))
            yield pa.RecordBatch.from_arrays([keys, batch.column("weight")], ["key", "weight"])

    single = table.filter(F.col("df") == 1).select(F.col("weight").cast("double")).first()
    hashed = several.select("term", F.col("weight").cast("double").alias("weight")).mapInArrow(run, "key bigint, weight double")
    return HeldTerms(hashed.toArrow(), dim, single[0] if single else 0.0)


def term_counts(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and ``terms, tfs, n``: the distinct terms of each text, how often
    each occurs, and how many occurrences there are.

    Texts are taken apart where they are read, once; weights, vectors and
    postings come from these counts.
    """
    read = df.select(*keep, terms(text).alias("_terms"))
    made = [T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("tfs", T.ArrayType(T.IntegerType())), T.StructField("n", T.IntegerType())]
    schema = T.StructType([*read.schema.fields[:-1], *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            lists = batch.column("_terms")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            encoded = pc.list_flatten(lists).dictionary_encode()
            width = max(1, len(encoded.dictionary))
            row = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
            keys, counts = np.unique(row * width + encoded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            rows, codes = np.divmod(keys, width)
            offsets = pa.array(np.searchsorted(rows, np.arange(len(lengths) + 1)).astype(np.int32))
            columns = [
                pa.ListArray.from_arrays(offsets, encoded.dictionary.take(pa.array(codes))),
                pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32))),
                pa.array(lengths.astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], schema.names)

    return read.mapInArrow(run, schema)


def counted_idf(counts: DataFrame, n_chunks: int) -> DataFrame:
    """``term_idf`` from term counts."""
    found = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return found.select("term", "df", idf_value(n_chunks, F.col("df")).alias("idf"))


def term_vectors(counts: DataFrame, keep: list[str], vocabulary: Vocabulary | HeldTerms) -> DataFrame:
    """Unit vectors ``buckets, weights`` of term counts; rows without known terms are dropped.

    Rows are worked on where they are: nothing is shuffled.
    """
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary)
    read = counts.select(*keep, "terms", "tfs")
    schema = T.StructType([*read.schema.fields[:-2], *VECTOR_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sums = shared.value.sums(batch.column("terms"), batch.column("tfs"))
            yield _unit(batch, keep, *sums, schema.names)

    return read.mapInArrow(run, schema)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of bounded rows, as what is made of a row's terms is larger than they are."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def _unit(batch: pa.RecordBatch, keep: list[str], offsets: np.ndarray, buckets: np.ndarray, sums: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """The rows that have entries, with these scaled to unit length."""
    counts = np.diff(offsets)
    row = np.repeat(np.arange(len(counts)), counts)
    sums = sums / np.sqrt(np.bincount(row, sums * sums, len(counts)))[row]
    made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v)) for v in (buckets.astype(np.int32), sums.astype(np.float32))]
    out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], names)
    return out.filter(pa.array(counts > 0))


def embed_hash(
    df: DataFrame,
    keep: list[str],
    text: str = "text",
    dim: int = DIMENSION,
    idf: DataFrame | None = None,
    n_chunks: int = 0,
) -> DataFrame:
    """A sparse unit vector ``buckets, weights`` beside the ``keep`` columns."""
    return embed_counts(term_counts(df, keep, text), keep, dim, idf, n_chunks)


def embed_counts(
    counts: DataFrame, keep: list[str], dim: int = DIMENSION, idf: DataFrame | None = None, n_chunks: int = 0, own: bool = False
) -> DataFrame:
    """E2 from term counts.

    The weight of a bucket is the summed idf of the term occurrences in it,
    scaled to unit length and stored as 32-bit float. Terms the idf table lacks
    are dropped, rows left without terms too. While the table is within bounds
    the tasks hold it and nothing is shuffled; ``idf=None`` counts plain
    occurrences. ``own`` says that the table was counted from these very rows:
    then tasks need only the terms that several rows have.
    """
    if idf is None:
        found = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        idf, n_chunks = found.withColumn("idf", F.lit(1.0)), n_chunks or max(1, counts.count())
    weighted = idf.select("term", "df", F.col("idf").alias("weight"), term_bucket(F.col("term"), dim).cast("long").alias("bucket"))
    vocabulary = held_terms(weighted, dim) if own else bounded_vocabulary(weighted)
    if vocabulary is not None:
        return term_vectors(counts, keep, vocabulary)
    return embed_by_join(counts, keep, weighted)


def embed_by_join(counts: DataFrame, keep: list[str], weighted: DataFrame) -> DataFrame:
    """E2 with a term table of any size: tasks hold the terms of most chunks, the others' counts join.

    One shuffle brings a row's sums and what its other terms add together, as
    lists of at most ``dim`` entries and a row for each other term. A term that
    the tasks do not hold is in few chunks, so no key is hot.
    """
    cut = _common_df(weighted)
    vocabulary = Vocabulary(weighted.filter(F.col("df") >= cut).select("term", F.col("bucket").cast("long"), F.col("weight").cast("double")).toArrow())
    known = _known_sums(counts, keep, vocabulary)
    others = _other_terms(counts, keep, vocabulary).join(weighted.filter(F.col("df") < cut), "term")
    single = others.select("_key", F.array(F.col("bucket").cast("int")).alias("buckets"), F.array(F.col("weight") * F.col("tf")).alias("sums"))
    lists = known.unionByName(single).repartition("_key").groupBy("_key").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("buckets", "sums")))
    read = lists.select("_key.*", "buckets", "sums")
    schema = T.StructType([*read.schema.fields[:-2], *VECTOR_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = batch.column("buckets")
            row = np.repeat(np.arange(len(found)), pc.list_value_length(found).to_numpy(zero_copy_only=False))
            flat = [pc.list_flatten(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("buckets", "sums")]
            yield _unit(batch, keep, *_summed(row, *flat, len(found)), schema.names)

    return read.mapInArrow(run, schema)


def _common_df(table: DataFrame) -> int:
    """From which frequency on the tasks hold a term: the least power of two with no more than ``KNOWN_TERMS`` terms."""
    doublings = F.floor(F.log2(F.greatest(F.col("df"), F.lit(1)))).cast("int").alias("d")
    sizes = {r["d"]: r["n"] for r in table.groupBy(doublings).agg(F.count("*").alias("n")).collect()}
    held = 0
    for d in sorted(sizes, reverse=True):
        held += sizes[d]
        if held > KNOWN_TERMS:
            return 2 ** (d + 1)
    return 0


def _summed(row: np.ndarray, buckets: np.ndarray, weights: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the summed weight of each bucket: ``(offsets, buckets, sums)``."""
    width = int(buckets.max()) + 1 if len(buckets) else 1
    key = row * width + buckets
    order = np.argsort(key, kind="stable")
    key, weights = key[order], weights[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
    sums = np.add.reduceat(weights, starts) if len(starts) else np.zeros(0)
    rows, found = np.divmod(key[starts], width)
    return np.searchsorted(rows, np.arange(n + 1)).astype(np.int32), found, sums


def _known_sums(counts: DataFrame, keep: list[str], vocabulary: Vocabulary) -> DataFrame:
    """``(_key, buckets, sums)`` of the terms that the vocabulary has."""
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary)
    read = counts.select(*keep, "terms", "tfs")
    schema = T.StructType([*read.schema.fields[:-2], T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("sums", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            offsets, buckets, sums = shared.value.sums(batch.column("terms"), batch.column("tfs"))
            made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v)) for v in (buckets.astype(np.int32), sums)]
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], schema.names)
            yield out.filter(pa.array(np.diff(offsets) > 0))

    return read.mapInArrow(run, schema).select(F.struct(*keep).alias("_key"), "buckets", "sums")


def _other_terms(counts: DataFrame, keep: list[str], vocabulary: Vocabulary) -> DataFrame:
    """``(_key, term, tf)`` of the terms that the vocabulary lacks."""
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary)
    read = counts.select(*keep, "terms", "tfs")
    schema = T.StructType([*read.schema.fields[:-2], T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = pc.list_flatten(batch.column("terms"))
            other = pc.invert(pc.is_in(found, value_set=shared.value.terms))
            row = pc.list_parent_indices(batch.column("terms")).filter(other)
            made = [found.filter(other), pc.list_flatten(batch.column("tfs")).filter(other)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in keep), *made], schema.names)

    return read.mapInArrow(run, schema).select(F.struct(*keep).alias("_key"), "term", "tf")


def to_dense(buckets: Column, weights: Column, dim: int = DIMENSION) -> Column:
    """Sparse entries as ``array<float>`` of the index dimension."""
    entries = F.map_from_arrays(buckets.cast("array<int>"), weights)
    return F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.try_element_at(entries, i), F.lit(0.0)).cast("float")
    )


def embed(df: DataFrame, make_model: Callable[[], Callable[[list[str]], list[list[float]]]], text: str = "text") -> DataFrame:
    """Add ``embedding`` by an injected model, built once per task.

    ``make_model()`` returns a callable from a list of texts to a list of
    vectors; it is called inside the task, for ``SLICE_ROWS`` texts at most.
    """
    schema = T.StructType(df.schema.fields + [T.StructField("embedding", T.ArrayType(T.FloatType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for batch in _slices(batches):
            vectors = model(batch.column(text).to_pylist())
            column = pa.array(vectors, pa.list_(pa.field("element", pa.float32(), nullable=False)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "embedding"])

    return df.mapInArrow(run, schema)


def vector_fault(embedding: Column, dim: int) -> Column:
    """Why a vector may not enter the index, or null when it may."""
    return (
        F.when(embedding.isNull(), "missing")
        .when(F.size(embedding) != dim, "wrong size")
        .when(F.exists(embedding, lambda x: x.isNull()), "null value")
        .when(F.exists(embedding, lambda x: F.isnan(x) | (F.abs(x) == float("inf"))), "not finite")
        .when(~F.exists(embedding, lambda x: x != 0), "zero norm")
    )


def validate_vectors(df: DataFrame, dim: int = DIMENSION, vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``; the rejected rows carry their ``fault``."""
    checked = df.withColumn("fault", vector_fault(F.col(vector), dim))
    return checked.filter(F.col("fault").isNull()).drop("fault"), checked.filter(F.col("fault").isNotNull())


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double; null when a norm is zero."""
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(norms > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot(a, b) / norms)))


def euclidean(a: Column, b: Column) -> Column:
    """E5: Euclidean distance in double."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
