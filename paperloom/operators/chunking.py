"""Chunking: fixed size, hierarchical and semantic.

All three are projections: a document is cut inside its own row and the pieces
are exploded, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.text import sentences, terms, tokens
from paperloom.operators.embedding import DIMENSION, term_bucket
from paperloom.staging import once


def _pieces(toks: Column, max_tokens: int, overlap: int) -> Column:
    """Array of ``(start, tokens)`` pieces of one token array; null when empty."""
    step = max_tokens - overlap
    n = F.size(toks)
    last = F.greatest(F.lit(1), F.ceil((n - overlap) / F.lit(step))).cast("int") - 1
    return F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.slice(toks, i * step + 1, F.lit(max_tokens)),
        ),
    )


def chunk_id(doc: str, *indexes: str) -> Column:
    return F.concat_ws("#", F.col(doc), *[F.col(i) for i in indexes])


def chunk_fixed(
    df: DataFrame,
    max_tokens: int = 300,
    overlap_pct: int = 5,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Chunks of at most ``max_tokens``, neighbours sharing ``overlap_pct`` %."""
    overlap = ceil(max_tokens * overlap_pct / 100)
    keep = [c for c in df.columns if c != text]
    return (
        df.withColumn("_tokens", tokens(text))
        .select(*keep, F.posexplode(_pieces(F.col("_tokens"), max_tokens, overlap)).alias("chunk_idx", "_piece"))
        .select(
            *keep,
            "chunk_idx",
            chunk_id(doc, "chunk_idx").alias("chunk_id"),
            F.array_join("_piece", " ").alias("text"),
            F.size("_piece").alias("n_tokens"),
        )
    )


def chunk_hierarchical(
    df: DataFrame,
    parent_tokens: int = 1000,
    child_tokens: int = 500,
    overlap: int = 50,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Children inside parents; search hits children, answers show parents."""
    keep = [c for c in df.columns if c != text]
    return (
        df.withColumn("_tokens", tokens(text))
        .select(*keep, F.posexplode(_pieces(F.col("_tokens"), parent_tokens, overlap)).alias("parent_idx", "_parent"))
        .select(*keep, "parent_idx", F.posexplode(_pieces(F.col("_parent"), child_tokens, overlap)).alias("child_idx", "_piece"))
        .select(
            *keep,
            "parent_idx",
            "child_idx",
            chunk_id(doc, "parent_idx").alias("parent_id"),
            chunk_id(doc, "parent_idx", "child_idx").alias("chunk_id"),
            F.array_join("_piece", " ").alias("text"),
            F.size("_piece").alias("n_tokens"),
        )
    )


def gap_distances(buckets: pa.Array, buffer: int) -> pa.Array:
    """Cosine distances of neighbouring sentences, for a batch of documents.

    ``buckets`` holds one list of term buckets per sentence and document. A
    sentence is compared by the counts of itself and its ``buffer`` neighbours
    on both sides; a document of n sentences gets n - 1 distances.
    """
    per_doc = pc.fill_null(pc.list_value_length(buckets), 0).to_numpy(zero_copy_only=False)
    inner = pc.list_flatten(buckets)
    per_sentence = pc.list_value_length(inner).to_numpy(zero_copy_only=False)
    # Sentences are numbered through, leaving room between documents, so that
    # neither neighbours nor products reach from one document into the next.
    room = 2 * buffer + 2
    doc = np.repeat(np.arange(len(per_doc), dtype=np.int64), per_doc)
    place = np.arange(len(doc), dtype=np.int64) + room * (doc + 1)
    width = int(place[-1]) + room if len(place) else 1
    key = pc.list_flatten(inner).to_numpy(zero_copy_only=False) * np.int64(width) + np.repeat(place, per_sentence)
    keys, n = np.unique(key, return_counts=True)
    spread = np.concatenate([keys + o for o in range(-buffer, buffer + 1)])
    keys, where = np.unique(spread, return_inverse=True)
    count = np.bincount(where, np.tile(n, 2 * buffer + 1), len(keys))
    at = keys % width
    norm = np.sqrt(np.bincount(at, count * count, width + 1))
    both = np.flatnonzero(keys[1:] == keys[:-1] + 1)
    product = np.bincount(at[both], count[both] * count[both + 1], width + 1)
    first = place[:-1][doc[:-1] == doc[1:]]
    norms = norm[first] * norm[first + 1]
    distance = 1 - np.divide(product[first], norms, out=np.zeros(len(first)), where=norms > 0)
    ends = np.cumsum(np.maximum(per_doc - 1, 0))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(distance))


def with_gaps(df: DataFrame, buffer: int, doc: str, text: str, dim: int = DIMENSION) -> DataFrame:
    """``(doc, _sentences, _gaps)`` and all columns but the text of documents with a sentence.

    Each document is worked on in its own row; only bucket numbers go to the
    array code and only distances come back.
    """

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def gaps(buckets: pa.Array) -> pa.Array:
        return gap_distances(buckets, buffer)

    others = [c for c in df.columns if c not in (doc, text)]
    cut = once(df.select(doc, text, *others), _sentences=sentences(text)).filter(F.size("_sentences") > 0)
    numbered = F.transform("_sentences", lambda s: F.transform(terms(s), lambda t: term_bucket(t, dim)))
    return cut.select(doc, *others, "_sentences", gaps(numbered).alias("_gaps")).withColumn(
        "_gaps", F.transform("_gaps", lambda d: F.round(d, 6))
    )


# Texts a model is given at a time; no more vectors than these are held.
MODEL_TEXTS = 256


def vector_distances(texts: list[str], model: Callable[[list[str]], list], size: int = MODEL_TEXTS) -> np.ndarray:
    """Cosine distance of each text's vector to the next one's.

    The model sees ``size`` texts at a time, and only the last vector of a
    slice is carried on. A vector of zeros, or with a value that is not finite,
    is at distance 1 from any other.
    """
    found, last = [], None
    for at in range(0, len(texts), size):
        part = texts[at : at + size]
        vectors = np.asarray(model(part), dtype=np.float64)
        if vectors.ndim != 2 or len(vectors) != len(part):
            raise ValueError(f"the model gave {vectors.shape} for {len(part)} texts")
        rows = vectors if last is None else np.vstack([last, vectors])
        usable = np.isfinite(rows).all(axis=1)
        rows = np.where(usable[:, None], rows, 0.0)
        norms = np.sqrt((rows * rows).sum(axis=1))
        both = norms[:-1] * norms[1:]
        dots = (rows[:-1] * rows[1:]).sum(axis=1)
        found.append(1 - np.divide(dots, both, out=np.zeros(len(both)), where=both > 0))
        last = vectors[-1]
    return np.concatenate(found) if found else np.zeros(0)


def with_model_gaps(df: DataFrame, buffer: int, doc: str, text: str, make_model: Callable, size: int = MODEL_TEXTS) -> DataFrame:
    """As ``with_gaps``, by vectors of an injected model.

    A sentence is embedded together with its ``buffer`` neighbours on both
    sides. The sentences of all documents of a batch go to the model in slices,
    whatever document they are from, and distances come back to the row they
    belong to: nothing is shuffled. ``make_model()`` is called once in a task.
    Documents of under three sentences cannot be cut and are not sent.
    """

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def gaps(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = make_model()
        for groups in batches:
            per_doc = pc.fill_null(pc.list_value_length(groups), 0).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(per_doc)), per_doc)
            distances = vector_distances(pc.list_flatten(groups).to_pylist(), model, size)
            inside = distances[owner[:-1] == owner[1:]] if len(owner) else distances
            ends = np.cumsum(np.maximum(per_doc - 1, 0))
            yield pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(inside))

    others = [c for c in df.columns if c not in (doc, text)]
    cut = once(df.select(doc, text, *others), _sentences=sentences(text)).filter(F.size("_sentences") > 0)

    def around(_: Column, i: Column) -> Column:
        first = F.greatest(i - buffer, F.lit(0))
        return F.array_join(F.slice("_sentences", first + 1, i + buffer - first + 1), " ")

    groups = F.when(F.size("_sentences") >= 3, F.transform("_sentences", around)).otherwise(F.array().cast("array<string>"))
    return cut.select(doc, *others, "_sentences", gaps(groups).alias("_gaps")).withColumn(
        "_gaps", F.transform("_gaps", lambda d: F.round(d, 6))
    )


def sentence_distances(df: DataFrame, buffer: int = 1, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """V3: ``(doc, sent, sentence, distance)``; distance to the next sentence."""
    entries = F.transform(
        "_sentences", lambda s, i: F.struct(i.alias("sent"), s.alias("sentence"), F.get("_gaps", i).alias("distance"))
    )
    return with_gaps(df, buffer, doc, text).select(doc, F.explode(entries).alias("_s")).select(doc, "_s.*")


def _percentile(values: Column, share: float) -> Column:
    """Interpolated percentile of an array of numbers."""
    ordered, position = F.sort_array(values), (F.size(values) - 1) * F.lit(share)
    low = F.get(ordered, F.floor(position).cast("int"))
    high = F.get(ordered, F.ceil(position).cast("int"))
    return F.round(low + (high - low) * (position - F.floor(position)), 6)


def chunk_semantic(
    df: DataFrame,
    max_tokens: int = 300,
    buffer: int = 1,
    percentile: int = 90,
    doc: str = "doc_id",
    text: str = "text",
    make_model: Callable | None = None,
) -> DataFrame:
    """Cut where the distance to the next sentence is above the percentile.

    Documents of fewer than three sentences stay one segment; a long segment is
    cut at ``max_tokens`` without overlap. A projection as well. Distances are
    those of counted terms, or of an injected model's vectors; ``make_model``
    is as in ``embed``.
    """
    gaps = with_gaps(df, buffer, doc, text) if make_model is None else with_model_gaps(df, buffer, doc, text, make_model)
    # once: the limit is not to be found again for every sentence
    marked = once(gaps, _limit=_percentile(F.col("_gaps"), percentile / 100))
    n = F.size("_sentences")
    breaks = F.filter(F.sequence(F.lit(1), n - 1), lambda i: F.get("_gaps", i - 1) > F.col("_limit"))
    starts = F.concat(F.array(F.lit(0)), F.when(n >= 3, breaks).otherwise(F.array().cast("array<int>")))
    others = [c for c in df.columns if c not in (doc, text)]
    bounds = marked.select(doc, *others, "_sentences", starts.alias("_starts"))
    segments = F.transform(
        "_starts",
        lambda start, i: F.array_join(
            F.slice("_sentences", start + 1, F.coalesce(F.get("_starts", i + 1), n) - start), " "
        ),
    )
    return (
        bounds.select(doc, *others, F.posexplode(segments).alias("segment", "_text"))
        .select(doc, *others, "segment", tokens("_text").alias("_tokens"))
        .select(doc, *others, "segment", F.posexplode(_pieces(F.col("_tokens"), max_tokens, 0)).alias("part", "_piece"))
        .select(
            doc,
            *others,
            "segment",
            "part",
            chunk_id(doc, "segment", "part").alias("chunk_id"),
            F.array_join("_piece", " ").alias("text"),
            F.size("_piece").alias("n_tokens"),
        )
    )
