"""An index kept in segments, so that a batch of changes costs what it changes.

A segment holds the chunks, term counts, hashes and, with a model, vectors of
the documents one batch brought. Documents that a batch changes or removes get
a tombstone in its segment, which hides their rows in earlier ones. Each
segment also has what its batch adds to and takes from the document frequency
of each term, so frequencies of the whole index are sums over segments. The
manifest names the segments in force; it is replaced by renaming a finished
file, and a batch that breaks off leaves the one before. Compaction writes the
live rows as one segment.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.operators.chunking import chunk_fixed
from paperloom.operators.embedding import DIMENSION, embed, embed_counts, idf_value, term_counts, validate_vectors
from paperloom.operators.ingest import Chunker, Index, MakeModel, part_of, parts_for, text_hash
from paperloom.shipping import ship_package
from paperloom.staging import broadcast_if_small, stage

# Tombstones that every task may hold; more are joined by shuffle.
MAX_TOMBSTONES = 500_000
TABLES = ("chunks", "counts", "frequencies", "documents", "tombstones", "vectors", "rejects")


@dataclass(frozen=True)
class Segment:
    seq: int
    path: str
    buried: int  # documents it hides in earlier segments
    n_chunks: int  # what it adds to the index's chunks, and to their terms
    n_terms: int


@dataclass(frozen=True)
class Manifest:
    number: int
    segments: tuple[Segment, ...]
    batch: int | None  # the last batch that is in
    dim: int
    metadata: tuple[str, ...]
    modelled: bool
    schemas: dict  # of each table, as all segments have them

    @property
    def n_chunks(self) -> int:
        return sum(s.n_chunks for s in self.segments)

    @property
    def n_terms(self) -> int:
        return sum(s.n_terms for s in self.segments)

    @property
    def next_seq(self) -> int:
        return max((s.seq for s in self.segments), default=0) + 1


# --- the manifest ----------------------------------------------------------


def _system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, folder: str) -> list[str]:
    system, path = _system(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def _manifests(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in _names(spark, folder) if n.startswith("manifest-")]


def latest_manifest(spark: SparkSession, folder: str) -> Manifest | None:
    """The manifest in force; None before the first batch."""
    names = _manifests(spark, folder)
    if not names:
        return None
    said = json.loads(spark.read.text(f"{folder}/{names[-1]}", wholetext=True).first()[0])
    said["segments"] = tuple(Segment(**s) for s in said["segments"])
    return Manifest(**{**said, "metadata": tuple(said["metadata"])})


def _publish(spark: SparkSession, folder: str, manifest: Manifest) -> Manifest:
    """Put a manifest in force: written whole under another name, then renamed.

    Raises RuntimeError if another writer was faster; its manifest stands.
    """
    system, path = _system(spark, folder)
    make = spark._jvm.org.apache.hadoop.fs.Path
    draft, final = make(path, f"draft-{uuid.uuid4().hex}"), make(path, f"manifest-{manifest.number:09d}")
    out = system.create(draft, False)
    out.write(bytearray(json.dumps(asdict(manifest)).encode()))
    out.close()
    if system.exists(final) or not system.rename(draft, final):
        system.delete(draft, False)
        raise RuntimeError(f"manifest {manifest.number} was written by another job")
    return manifest


# --- reading ---------------------------------------------------------------


def _table(spark: SparkSession, manifest: Manifest, name: str, segments: tuple[Segment, ...] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(manifest.schemas[name])
    paths = [f"{s.path}/{name}" for s in (manifest.segments if segments is None else segments)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _live(spark: SparkSession, manifest: Manifest, name: str) -> DataFrame:
    """Rows of all segments that no later tombstone hides; nothing is joined where nothing was buried."""
    rows = _table(spark, manifest, name)
    burying = tuple(s for s in manifest.segments if s.buried)
    if not burying:
        return rows
    hidden = _table(spark, manifest, "tombstones", burying).groupBy("doc_id").agg(F.max("seq").alias("_dead"))
    small = sum(s.buried for s in burying) <= MAX_TOMBSTONES
    marked = rows.join(F.broadcast(hidden) if small else hidden, "doc_id", "left")
    return marked.filter("_dead IS NULL OR seq >= _dead").drop("_dead")


def load_segments(spark: SparkSession, folder: str, make_model: MakeModel | None = None) -> Index:
    """The index as the manifest in force says; every operator on an index takes it.

    Weights follow from the summed frequencies, so vectors of hashed terms are
    made from the counts as they are read; a model's vectors are stored.
    """
    manifest = latest_manifest(spark, folder)
    if manifest is None:
        raise ValueError(f"no index in {folder}")
    if manifest.modelled != (make_model is not None):
        raise ValueError("an index of model vectors is loaded with its model, and no other is")
    ship_package(spark)
    n, keep = manifest.n_chunks, ["chunk_id", "doc_id", *manifest.metadata]
    parts, _ = parts_for(n)
    chunks = _live(spark, manifest, "chunks").drop("seq").withColumn("part", part_of("chunk_id", parts))
    counts = _live(spark, manifest, "counts").drop("seq")
    summed = _table(spark, manifest, "frequencies").groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")
    terms = stage(summed.select("term", "df", idf_value(n, F.col("df")).alias("idf")), "terms")
    vectors = _live(spark, manifest, "vectors").drop("seq") if manifest.modelled else embed_counts(counts, keep, manifest.dim, terms, max(n, 1))
    listed = counts.select("chunk_id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("_t"))
    postings = listed.select(F.col("_t.terms").alias("term"), "chunk_id", F.col("_t.tfs").alias("tf"), "n", part_of("_t.terms", parts).alias("part"))
    return Index(
        folder, chunks, counts, postings, terms, vectors, n_chunks=n, mean_terms=manifest.n_terms / n if n else 0.0, parts=parts, dim=manifest.dim,
        metadata=manifest.metadata, partition_by=None, make_model=make_model,
    )


# --- writing ---------------------------------------------------------------


def add_segment(
    spark: SparkSession,
    folder: str,
    docs: DataFrame,
    removed: DataFrame | None = None,
    batch: int | None = None,
    metadata: tuple[str, ...] = (),
    dim: int = DIMENSION,
    chunker: Chunker = chunk_fixed,
    make_model: MakeModel | None = None,
) -> Manifest:
    """Bring ``docs`` (``doc_id, text`` and metadata, one row an id) into the index, and take ``removed`` ids out.

    Documents whose text is in the index already are left alone; changed ones
    replace what was there. Only what comes is chunked, counted and embedded,
    and only that is written, with tombstones for what goes. With ``batch`` a
    batch that is in already is not brought in again. ``metadata``, ``dim`` and
    whether there is a model are fixed by the first batch.
    """
    ship_package(spark)
    folder = folder.rstrip("/")
    before = latest_manifest(spark, folder)
    if before is not None and batch is not None and before.batch is not None and batch <= before.batch:
        return before
    if before is not None:
        dim, metadata = before.dim, before.metadata
        if before.modelled != (make_model is not None):
            raise ValueError("an index of model vectors is kept up with its model, and no other is")
    seq = before.next_seq if before else 1
    path, mark = f"{folder}/segments/{seq:09d}-{uuid.uuid4().hex}", F.lit(seq).cast("bigint").alias("seq")
    came = docs.select("doc_id", "text", *metadata, text_hash(F.col("text")).alias("hash"))
    there = _live(spark, before, "documents").select("doc_id", F.struct("hash").alias("_old")) if before else None
    if there is None:
        fresh, gone = came, came.filter("1 = 0").select("doc_id")
    else:
        came = stage(came, "came")
        told = came.select("doc_id", "hash").join(there, "doc_id", "left")
        same = F.coalesce(F.col("_old.hash").eqNullSafe(F.col("hash")) & F.col("_old").isNotNull(), F.lit(False))
        told = stage(told.select("doc_id", F.col("_old").isNotNull().alias("known"), same.alias("same")), "told")
        fresh = came.join(broadcast_if_small(told.filter("NOT same").select("doc_id"), MAX_TOMBSTONES), "doc_id", "left_semi")
        gone = told.filter("known AND NOT same").select("doc_id")
        if removed is not None:
            out = removed.select("doc_id").join(came.select("doc_id"), "doc_id", "left_anti")
            gone = gone.unionByName(there.select("doc_id").join(out, "doc_id", "left_semi"))
    gone = stage(gone.distinct(), "gone")
    buried = gone.count()

    keep = ["chunk_id", "doc_id", *metadata]
    chunker(fresh.select("doc_id", "text", *metadata)).withColumn("seq", mark).write.parquet(f"{path}/chunks")
    schema = spark.read.parquet(f"{path}/chunks").schema if before is None else T.StructType.fromJson(before.schemas["chunks"])
    chunks = spark.read.schema(schema).parquet(f"{path}/chunks")
    made = term_counts(chunks, [*keep, "seq"])
    made.write.parquet(f"{path}/counts")
    counts = spark.read.schema(made.schema).parquet(f"{path}/counts")
    changes = counts.select(F.explode("terms").alias("term"), F.lit(1).alias("df"))
    n_chunks, n_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if buried:
        dead = _live(spark, before, "counts").join(broadcast_if_small(gone, MAX_TOMBSTONES), "doc_id", "left_semi")
        dead = stage(dead.select("terms", "n"), "dead")
        lost, lost_terms = dead.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        n_chunks, n_terms = n_chunks - lost, n_terms - lost_terms
        changes = changes.unionByName(dead.select(F.explode("terms").alias("term"), F.lit(-1).alias("df")))
    tables = {
        "frequencies": changes.groupBy("term").agg(F.sum("df").alias("df")).filter("df <> 0"),
        "documents": fresh.select("doc_id", "hash", mark),
        "tombstones": gone.select("doc_id", mark),
    }
    if make_model is not None:
        embedded = stage(embed(chunks.select(*keep, "seq", "text"), make_model).drop("text"), "embedded")  # the model is asked once
        tables["vectors"], tables["rejects"] = validate_vectors(embedded, dim)
    for name, rows in tables.items():
        rows.write.parquet(f"{path}/{name}")
    schemas = before.schemas if before else {n: s.jsonValue() for n, s in {"chunks": chunks.schema, "counts": made.schema, **{k: v.schema for k, v in tables.items()}}.items()}
    added = Segment(seq, path, buried, int(n_chunks), int(n_terms))
    if before is None:
        return _publish(spark, folder, Manifest(1, (added,), batch, dim, tuple(metadata), make_model is not None, schemas))
    now = batch if batch is not None else before.batch
    return _publish(spark, folder, replace(before, number=before.number + 1, segments=(*before.segments, added), batch=now))


def compact(spark: SparkSession, folder: str) -> Manifest:
    """The live rows of all segments as one, without tombstones; the index stays the same.

    A job of its own, for when segments or tombstones have become many. Old
    segments stay for those who still read them; ``remove_unused`` takes them away.
    """
    folder = folder.rstrip("/")
    before = latest_manifest(spark, folder)
    if before is None or (len(before.segments) == 1 and not before.segments[0].buried):
        return before
    seq = before.next_seq
    path, mark = f"{folder}/segments/{seq:09d}-{uuid.uuid4().hex}", F.lit(seq).cast("bigint")
    for name in TABLES:
        if name not in before.schemas:
            continue
        if name == "frequencies":
            rows = _table(spark, before, name).groupBy("term").agg(F.sum("df").alias("df")).filter("df <> 0")
        elif name == "tombstones":
            rows = _table(spark, before, name, ())
        else:
            rows = _live(spark, before, name).withColumn("seq", mark)
        rows.select(T.StructType.fromJson(before.schemas[name]).fieldNames()).write.parquet(f"{path}/{name}")
    whole = Segment(seq, path, 0, before.n_chunks, before.n_terms)
    return _publish(spark, folder, replace(before, number=before.number + 1, segments=(whole,)))


def remove_unused(spark: SparkSession, folder: str) -> int:
    """Delete manifests before the one in force, and segments that it does not name (of broken batches, too)."""
    folder = folder.rstrip("/")
    manifest = latest_manifest(spark, folder)
    if manifest is None:
        return 0
    system, _ = _system(spark, folder)
    make = spark._jvm.org.apache.hadoop.fs.Path
    named = {s.path.rsplit("/", 1)[1] for s in manifest.segments}
    old = [f"{folder}/{n}" for n in _manifests(spark, folder)[:-1]]
    old += [f"{folder}/segments/{n}" for n in _names(spark, f"{folder}/segments") if n not in named]
    return sum(bool(system.delete(make(p), True)) for p in old)
