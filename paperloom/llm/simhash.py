"""Near-duplicate texts by SimHash, candidates pruned by pigeonring.

Two fingerprints of 64 bits that differ in at most 4 places, cut into 16
segments on a ring, have a start from which every chain of l segments differs
in at most l * 4 / 16 places. So the first three segments of such a chain are
equal and the next four hold at most one difference: dropping one of these four
gives a key of 24 equal bits. Every fingerprint has 64 such keys (16 starts, 4
dropped segments); rows that share one are candidates, the longer chains prune
them, and the count of all differing bits decides.

Where too many rows share such a key, their chain is followed further: its
first eleven segments hold at most two differences, so dropping two of them, at
most one of the first seven, gives keys of 36 equal bits, 352 of a fingerprint.

Only distinct fingerprints are compared, and compared pairs are joined into
trees inside the task, so a group of copies never becomes all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.components import connected_components, spanning
from paperloom.llm.rows import append_columns, packed, quoted, unpacked
from paperloom.operators.joins import join_unique
from paperloom.shipping import ship_package
from paperloom.staging import broadcast_if_small, stage

SHINGLE = 4
SEED = 42
DISTANCE = 4
SEGMENTS, SEGMENT_BITS = 16, 4
# Rows of one key that are compared with each other; the rows of a larger bucket are met
# by longer keys, and those of a large bucket of these by common neighbours, at the same result.
BUCKET = 1024
# Pairs held before they are joined into trees.
HELD_PAIRS = 1 << 19
# Documents to drop that are broadcast at most (16 bytes each); more are joined by shuffle.
MAX_BROADCAST_IDS = 500_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of a whole text; 0 without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - SHINGLE + 1)
    first, last = starts[:n].tolist(), ends[min(SHINGLE, len(words)) - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 65_536):
        block = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at : at + 65_536], last[at : at + 65_536])], "<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def add_fingerprint(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``fingerprint`` as a signed ``bigint``."""
    schema = T.StructType([T.StructField("fingerprint", T.LongType())])
    return append_columns(docs, text, lambda: lambda values: [[fingerprint(v.as_py()) for v in values]], schema, keep)


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def chain_keys(value: Column) -> Column:
    """The 64 keys of a fingerprint: start, dropped segment, the 24 bits that stay."""
    keys = []
    for start in range(SEGMENTS):
        turned = value if start == 0 else F.shiftleft(value, 4 * start).bitwiseOR(F.shiftrightunsigned(value, 64 - 4 * start))
        window = F.shiftrightunsigned(turned, 36)  # seven segments
        for dropped in range(4):
            mask = (1 << 28) - 1 - (15 << (4 * (3 - dropped)))
            keys.append(window.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(((start << 2) | dropped) << 28)))
    return F.array(*keys)


# What a long key leaves out of the eleven segments of its chain.
LONG = 11
_LEFT_OUT = [(x, y) for x, y in product(range(3, 7), range(7, LONG))] + list(combinations(range(7, LONG), 2))


def long_chain_keys(value: Column) -> Column:
    """The 352 long keys of a fingerprint, an array: start, two dropped segments, the 36 bits that stay."""
    bits = SEGMENT_BITS * LONG
    ways = []
    for start in range(SEGMENTS):
        for number, dropped in enumerate(_LEFT_OUT):
            mask = (1 << bits) - 1 - sum(15 << (SEGMENT_BITS * (LONG - 1 - d)) for d in dropped)
            ways.append((SEGMENT_BITS * start, mask, (start * len(_LEFT_OUT) + number) << bits))
    literal = F.from_json(F.lit(str([list(w) for w in ways])), "array<array<bigint>>")

    def key(way: Column) -> Column:
        turn = way[0].cast("int")
        turned = F.call_function("shiftleft", value, turn).bitwiseOR(F.call_function("shiftrightunsigned", value, (64 - turn) % 64))
        return F.shiftrightunsigned(turned, 64 - bits).bitwiseAND(way[1]).bitwiseOR(way[2])

    return F.transform(literal, key)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def close(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which candidate pairs differ in at most 4 bits; longer chains from ``start`` first."""
    apart = a ^ b
    turn = (start * SEGMENT_BITS).astype(np.uint64)
    back = (np.uint64(64) - turn) & np.uint64(63)
    ring = (apart << turn) | np.where(turn == 0, np.uint64(0), apart >> back)
    keep = np.ones(len(a), bool)
    for length in (11, 15):  # chains whose budget is about to grow
        at = np.flatnonzero(keep)
        bits = _popcount(ring[at] >> np.uint64(64 - SEGMENT_BITS * length))
        keep[at] = bits <= length * DISTANCE // SEGMENTS
    at = np.flatnonzero(keep)
    keep[at] = _popcount(apart[at]) <= DISTANCE
    return keep


def _links(batches: Iterator[pa.RecordBatch], bucket: int, bits: int, ways: int) -> Iterator[pa.RecordBatch]:
    """Trees of links among rows sorted by key, and the rows of large buckets.

    A row is compared with the ``bucket - 1`` rows before it that share its
    key. ``b`` is null for rows whose bucket holds more than that. Of a key,
    ``bits`` are the fingerprint's; above them stand its start and which of
    ``ways`` to leave segments out it is.
    """
    keys, prints, index = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        old = len(keys)
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        prints = np.concatenate([prints, batch.column(1).to_numpy().view(np.uint64)])
        n = len(keys)
        # place of each row in its bucket
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[new, n])
        offset = np.repeat(np.r_[index[0] if old else 0, np.zeros(len(new) - 1, np.int64)] if len(new) else new, sizes)
        index = offset + np.arange(n) - np.repeat(new, sizes)
        found_a, found_b, held = [], [], 0
        rows = np.arange(max(old, 1), n)
        for back in range(1, bucket):
            rows = rows[(rows >= back) & (index[rows] >= back)]
            if len(rows) == 0:
                break
            a, b = prints[rows], prints[rows - back]
            hit = close(a, b, (keys[rows] >> bits) // ways)
            found_a.append(a[hit].view(np.int64))
            found_b.append(b[hit].view(np.int64))
            held += int(hit.sum())
            if held > HELD_PAIRS:
                a, b = spanning(np.concatenate(found_a), np.concatenate(found_b))
                found_a, found_b, held = [a], [b], len(a)
        if held:
            a, b = spanning(np.concatenate(found_a), np.concatenate(found_b))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        late = np.arange(old, n)
        late = late[index[late] >= bucket]
        if len(late):
            early = late[index[late] < 2 * bucket] - bucket
            crowded = np.unique(np.concatenate([prints[late], prints[early]])).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(crowded), pa.nulls(len(crowded), pa.int64())], names=["a", "b"])
        keep = max(0, n - bucket)
        keys, prints, index = keys[keep:], prints[keep:], index[keep:]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every fingerprint with all that differ from it in at most 2 bits."""
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    flips = np.concatenate([np.zeros(1, np.uint64), bits, bits[i] | bits[j]])
    for batch in batches:
        for value in batch.column(0).to_numpy().view(np.uint64):
            near = (flips ^ value).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(np.full(len(near), value, np.uint64).view(np.int64))], names=["near", "a"])


def _met(distinct: DataFrame, keys: Column, bits: int, ways: int) -> tuple[DataFrame, DataFrame]:
    """Links of the values that share a key with few others, and the values that share one with many."""
    keyed = distinct.select(F.explode(keys).alias("key"), F.col(distinct.columns[0]).alias("f"))
    compared = partial(_links, bucket=BUCKET, bits=bits, ways=ways)
    met = stage(keyed.repartition("key").sortWithinPartitions("key", "f").mapInArrow(compared, "a bigint, b bigint").distinct(), "links")
    return met.filter("b IS NOT NULL"), met.filter("b IS NULL").select("a").distinct()


def link_fingerprints(distinct: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect just the fingerprints within 4 bits.

    ``distinct`` has one ``bigint`` column of distinct values. Buckets of up to
    ``BUCKET`` rows are compared as they stream by. Both values of a pair in a
    larger one are crowded, so the crowded values alone are compared again by
    long keys, of which 4,096 times as many differ. What is crowded there too
    is joined over common neighbours: two values lie within 4 bits just if some
    value lies within 2 bits of both. That makes 2,081 rows of a value but no
    pairs, so it stays linear in the largest bucket.
    """
    ship_package(distinct.sparkSession)
    links, crowded = _met(distinct, chain_keys(F.col(distinct.columns[0])), 28, 4)
    if crowded.isEmpty():
        return links
    more, crowded = _met(crowded, long_chain_keys(F.col("a")), SEGMENT_BITS * LONG, len(_LEFT_OUT))
    links = links.unionByName(more)
    if crowded.isEmpty():
        return links
    near = crowded.mapInArrow(_neighbours, "near bigint, a bigint")
    # at most 2,081 distinct values lie within 2 bits of one
    around = near.groupBy("near").agg(F.collect_set("a").alias("all"), F.min("a").alias("b")).filter(F.size("all") > 1)
    joined = around.select(F.explode("all").alias("a"), "b").filter("a <> b").distinct()
    return links.unionByName(joined)


def simhash_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id, root``.

    ``component_id`` is the smallest id that can be reached over links of at
    most 4 differing bits, the row's own included; rows with equal fingerprints
    are linked, texts without words (null, empty, blanks) among them. Null ids
    take part but are never the smallest; a component of null ids only has a
    null ``component_id``. Texts of any length are read whole. Repeated rows give
    repeated rows. ``root`` is the
    smallest fingerprint of the component, which names it where ids are null.
    """
    source = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("text"))
    marked = stage(add_fingerprint(source, keep=["doc_id"]), "fingerprints")
    distinct = stage(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    labels = connected_components(link_fingerprints(distinct.select("fingerprint")))
    rooted = distinct.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").select("fingerprint", "component_id", "root")
    return join_unique(marked, named, ["fingerprint"], "inner").select("doc_id", "fingerprint", "component_id", "root")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each component: the one of the smallest id.

    Of several rows with that id one stays, and one of a component without ids.
    All columns are kept. The ids to drop are broadcast up to a checked number
    and shuffled beyond; rows whose id stands for itself are not shuffled then.
    """
    labelled = stage(simhash_components(docs, text, doc_id), "components")
    repeated = stage(labelled.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_doc")), "repeated")
    losers = labelled.filter("doc_id <> component_id").select(F.col("doc_id").alias("_doc"))
    away = stage(losers.unionByName(repeated.filter("_doc IS NOT NULL")).distinct(), "losers")
    away = broadcast_if_small(away, MAX_BROADCAST_IDS)
    rows = docs.select(packed(docs), F.col(quoted(doc_id)).alias("_doc"), F.col(quoted(text)).alias("_text"))
    single = rows.filter("_doc IS NOT NULL").join(away, "_doc", "left_anti").select(*unpacked(docs.columns))
    if repeated.isEmpty():
        return single
    again = rows.join(repeated.withColumnRenamed("_doc", "_again"), F.col("_doc").eqNullSafe(F.col("_again")), "left_semi")
    marked = add_fingerprint(again, "_text", ["_row", "_doc"])
    names = labelled.select("fingerprint", "component_id", "root").distinct()
    chosen = marked.join(names, "fingerprint").filter(F.col("_doc").eqNullSafe(F.col("component_id")))
    return single.unionByName(chosen.dropDuplicates(["root"]).select(*unpacked(docs.columns)))
