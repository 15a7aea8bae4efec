"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams, most frequent first. A text
is given the language whose profile is nearest to its own in the out-of-place
measure: the sum, over the text's n-grams, of how far their ranks lie apart,
an n-gram missing from the language counting as a whole profile length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from paperloom.llm.rows import append_columns
from paperloom.shipping import ship_package

# length of a profile
PROFILE = 300
# labelled documents each language is learned from (expected number)
PER_LANGUAGE = 2_000
# places of a text whose n-grams are counted at once
BLOCK = 1 << 20
# distinct n-grams a task holds before it hands its counts on
HELD = 1 << 20

UNKNOWN = "und"

WORD_END = np.uint64(1)
_BITS = np.uint64(21)

PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def symbols(text: str) -> np.ndarray:
    """Letters in lower case as code points + 1, a word end before, between and after words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.uint64)
    marked = np.where(letter, points + 1, 1)
    kept = marked[letter | np.r_[False, letter[:-1]]]
    return np.concatenate([[1], kept, [] if kept[-1] == 1 else [1]]).astype(np.uint64)


def count_ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the one- to three-grams of a whole text, by key.

    An n-gram's key packs its symbols into 21 bits each; n-grams lie within
    one word and its two ends.
    """
    places = symbols(text)
    found = []
    for start in range(0, len(places), BLOCK):
        one = places[start : start + BLOCK + 2]
        two = one[:-1] | (one[1:] << _BITS)
        three = two[:-1] | (one[2:] << (_BITS + _BITS))
        inside = one != WORD_END
        keys = [one[:BLOCK][inside[:BLOCK]], two[:BLOCK], three[:BLOCK][inside[1:-1][:BLOCK]]]
        found.append(np.unique(np.concatenate(keys), return_counts=True))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return found[0] if len(found) == 1 else merge(found)


def merge(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in counts]), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, np.concatenate([c for _, c in counts]))
    return keys, total


def profile(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent keys, most frequent first; ties by key."""
    if len(keys) > size:
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        often = counts >= floor
        keys, counts = keys[often], counts[often]
    return keys[np.argsort(-counts, kind="stable")][:size]


class Profiles:
    """Learned profiles and the distance of a text's profile to each."""

    def __init__(self, learned: dict[str, list[int]], size: int):
        self.size = size
        self.langs = sorted(learned)
        self.keys = np.unique(np.array([k for lang in self.langs for k in learned[lang]], np.uint64))
        # a row of ranks for each key, and one for keys that no language has
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int64)
        for column, lang in enumerate(self.langs):
            at = np.searchsorted(self.keys, np.array(learned[lang], np.uint64))
            self.ranks[at, column] = np.arange(len(at))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 for an equal profile, 0 for nothing in common."""
        keys, counts = count_ngrams(text or "")
        if not self.langs or len(keys) == 0:
            return UNKNOWN, 0.0
        own = profile(keys, counts, self.size)
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        at = np.where(self.keys[at] == own, at, len(self.keys))
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))  # ties: the first in order of names
        return self.langs[best], float(1 - apart[best] / (self.size * len(own)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn_profiles(
    labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", size: int = PROFILE, per_language: int = PER_LANGUAGE
) -> Profiles:
    """Profiles of every language among the labels.

    Learns from whole texts of about ``per_language`` documents of each
    language, taken by hash of their ids. Rows without label or text teach
    nothing, and a language whose texts hold no letter is not learned. What
    comes to the driver is ``size`` keys a language.
    """
    ship_package(labelled.sparkSession)
    rows = labelled.select(F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    totals = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), per_language / F.col("n"))
    drawn = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1_000_000)) < F.ceil(share * 1_000_000)
    # one row for each label: as many as there are languages to tell apart
    sample = rows.join(F.broadcast(totals), "lang").filter(drawn).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = held.setdefault(name, [])
                parts.append(count_ngrams(body))
                if sum(len(k) for k, _ in parts) > HELD:
                    held[name] = [merge(parts)]
                    if len(held[name][0][0]) > HELD // 2:
                        yield _counted(name, held.pop(name))
        for name, parts in held.items():
            yield _counted(name, parts)

    grams = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    best = grams.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= size).orderBy("lang", "rank").collect()
    learned: dict[str, list[int]] = {}
    for row in best:
        learned.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(learned, size)


def _counted(name: str, parts: list) -> pa.RecordBatch:
    keys, counts = merge(parts)
    return pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])


def identify_language(docs: DataFrame, profiles: Profiles, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from whole texts only.

    A null text, one without a letter, and every text when nothing was learned
    are ``und`` with score 0. A language equally near is taken in order of
    names. Rows stand for themselves; new columns replace those of their name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def make():
        learned = shared.value

        def work(values: pa.Array) -> list:
            said = [learned.predict(v.as_py()) for v in values]
            return [[s[0] for s in said], [s[1] for s in said]]

        return work

    return append_columns(docs, text, make, PREDICTED, keep)
