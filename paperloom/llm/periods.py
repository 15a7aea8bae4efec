"""Finding stretches of a text that repeat with a period, and collapsing them.

A run is a stretch of words with a smallest period q that holds at least
``exponent`` periods and that no neighbouring word extends. Runs of small
period are found by comparing each word with the one q places on. For longer
periods, scale s looks for periods from 2^s up to 2^(s+1): every stretch of
2^(s+1) words is hashed, and the least hash of each 2^s consecutive stretches
is a minimizer. Inside a run, what a window picks is picked again one period
on, and a stretch of more than a period's words stands nowhere between, as the
period would not be the smallest otherwise. So each run shows as two minimizers
of equal hash, one after the other at its period's distance; from there it is
extended word by word as far as it goes.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.rows import append_columns, quoted
from paperloom.staging import once

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# A run holds so many periods and so many words at least.
EXPONENT, LEAST = 4, 6
# Periods from 2^SCALE on are found by minimizers, shorter ones by scans.
SCALE = 4
# Bits of a packed minimizer that tell its place, so texts are worked on in pieces of fewer words or alone.
_PLACE = 28

_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def find_word_runs(ids: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` in the texts laid end to end in ``ids``.

    ``ids`` numbers the words; after each text stands a number that occurs
    once. ``starts`` has the place of each text and of the end. No run crosses
    a text's end. Hashes that collide (one pair in 2^64) could hide a run.
    """
    found = _by_scan(ids, min(1 << SCALE, int(np.diff(starts).max(initial=0)) // EXPONENT + 1))
    lengths = np.diff(starts) - 1
    scale, here = SCALE, (ids, np.zeros(1, np.int64), np.zeros(1, np.int64))
    while (long := lengths >= EXPONENT << scale).any():
        if not long.all():
            # only texts that can hold such a run; their places in the whole are kept
            pieces = [(a, b) for a, b, ok in zip(starts[:-1].tolist(), starts[1:].tolist(), long.tolist()) if ok]
            here = (
                np.concatenate([ids[a:b] for a, b in pieces]),
                np.cumsum([0] + [b - a for a, b in pieces[:-1]]),
                np.array([a for a, _ in pieces], np.int64),
            )
        part, at, origin = here
        for start, length, period in _by_minimizers(part, scale):
            text = int(np.searchsorted(at, start, "right")) - 1
            found.append((start - int(at[text]) + int(origin[text]), length, period))
        scale += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def _by_scan(ids: np.ndarray, end: int) -> list[tuple[int, int, int]]:
    """Runs of periods under ``end``: words equal to the one a period on, over enough places."""
    found = []
    for q in range(1, end):
        if len(ids) <= q:
            break
        differ = np.concatenate([[-1], np.flatnonzero(ids[:-q] != ids[q:]), [len(ids) - q]])
        equal = np.diff(differ) - 1
        for i in np.flatnonzero(equal + q >= max(LEAST, EXPONENT * q)):
            start, length = int(differ[i]) + 1, int(equal[i]) + q
            if _smallest(ids, start, length, q):
                found.append((start, length, q))
    return found


def _by_minimizers(ids: np.ndarray, scale: int) -> list[tuple[int, int, int]]:
    """Runs of periods from ``2^scale`` up to its double."""
    least = 1 << scale
    hashes = _hashes(ids, scale + 1)
    chosen = _minimizers(hashes, scale)
    if len(chosen) < 2:
        return []
    values = hashes[chosen]
    order = np.argsort(values, kind="stable")  # equal hashes stay in order of their places
    first, second = chosen[order[:-1]], chosen[order[1:]]
    apart = second - first
    pairs = (values[order[:-1]] == values[order[1:]]) & (apart >= least) & (apart < 2 * least)
    found, reached = [], {}
    seeds = sorted(zip(first[pairs].tolist(), apart[pairs].tolist()))
    for place, q in seeds:
        if place < reached.get(q, -1):
            continue  # inside what was extended already
        start, end = _extended(ids, place, q)
        reached[q] = end
        length = end - start + q
        if length >= max(LEAST, EXPONENT * q) and _smallest(ids, start, length, q):
            found.append((start, length, q))
    return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def _hashes(ids: np.ndarray, power: int) -> np.ndarray:
    """A hash of each stretch of ``2^power`` words, from those of its halves."""
    made = _mixed(ids.astype(np.uint64) + _MIX[0])
    for p in range(power):
        half = 1 << p
        if len(made) <= half:
            return made[:0]
        made = _mixed(made[:-half] * _MIX[0] + made[half:])
    return made


def _minimizers(hashes: np.ndarray, scale: int) -> np.ndarray:
    """Places of the least hash, and the first of equal ones, in each window of ``2^scale`` hashes."""
    if len(hashes) < 1 << scale:
        return np.zeros(0, np.int64)
    places = np.uint64((1 << _PLACE) - 1)
    least = (hashes & ~places) | np.arange(len(hashes), dtype=np.uint64)
    for p in range(scale):
        least = np.minimum(least[: -(1 << p)], least[1 << p :])
    places = (least & places).astype(np.int64)
    return places[np.flatnonzero(np.diff(places, prepend=-1))]


def _extended(ids: np.ndarray, place: int, q: int) -> tuple[int, int]:
    """How far to both sides of ``place`` words equal those ``q`` on."""
    end, step = place, 64
    while end < len(ids) - q:
        stop = min(end + step, len(ids) - q)
        differ = ids[end:stop] != ids[end + q : stop + q]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = stop, step * 2
    start, step = place, 64
    while start > 0:
        stop = max(start - step, 0)
        differ = (ids[stop:start] != ids[stop + q : start + q])[::-1]
        if differ.any():
            start -= int(differ.argmax())
            break
        start, step = stop, step * 2
    return start, end


@lru_cache(maxsize=4096)
def _prime_factors(q: int) -> tuple[int, ...]:
    found, d = [], 2
    while d * d <= q:
        if q % d == 0:
            found.append(d)
            while q % d == 0:
                q //= d
        d += 1
    return (*found, q) if q > 1 else tuple(found)


def _smallest(ids: np.ndarray, start: int, length: int, q: int) -> bool:
    """Whether no shorter period, which would divide ``q``, holds in the run."""
    # two periods tell as much as all of them
    stretch = ids[start : start + min(length, 2 * q)]
    return not any(np.array_equal(stretch[: -(q // p)], stretch[q // p :]) for p in _prime_factors(q))


RUNS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType()),
    ]
)


def periodic_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (``start, length, period`` in words) and ``collapsed``.

    ``collapsed`` has the words that are not repetitions, joined by one blank:
    of each run its first period stays. A null, empty or blank text has no
    words, no runs and an empty ``collapsed``. Whole texts are worked on,
    several at once up to bounds in rows and bytes, or one where it is larger;
    a text may have 2^28 words. Rows stand for themselves; columns of the new
    names are replaced, all others (or ``keep``) stay.
    """

    def make():
        return _work

    return append_columns(docs, text, make, RUNS, keep)


def _work(values: pa.Array) -> list:
    texts = [WORD.findall(t) if t else [] for t in values.to_pylist()]
    runs: list[list] = [[] for _ in texts]
    collapsed: list[str | None] = [None] * len(texts)
    numbers: dict[str, int] = {}
    parts, starts = [], [0]
    for i, words in enumerate(texts):
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        parts.append(np.array([-1 - i]))
        starts.append(starts[-1] + len(words) + 1)
    ids, bounds = np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array(starts)
    if len(ids) >= 1 << _PLACE:
        raise ValueError(f"a text has more than {1 << _PLACE} words")
    for start, length, period in find_word_runs(ids, bounds):
        i = int(np.searchsorted(bounds, start, "right")) - 1
        runs[i].append({"start": start - starts[i], "length": length, "period": period})
    for i, words in enumerate(texts):
        if runs[i]:
            gone = np.zeros(len(words) + 1, np.int64)
            for r in runs[i]:
                gone[r["start"] + r["period"]] += 1
                gone[r["start"] + r["length"]] -= 1
            kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
            words = [words[k] for k in kept.tolist()]
        collapsed[i] = " ".join(words)
    return [[len(t) for t in texts], runs, collapsed]


def longest(runs: Column) -> Column:
    """The longest run; of equal ones the first, then that of the smaller period; null if there is none."""
    order = F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(order)


def listed(runs: Column) -> Column:
    """Runs as lines of ``start,length,period``."""
    return F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")


def with_planted_periods(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the texts of a tenth of them made periodic from some word on, by the crc32 of their id."""
    h = F.crc32(F.col(quoted(doc_id)).cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.col(quoted(text)), F.lit(WORD.pattern), F.lit(0)))
    cut = once(docs, _words=words, _g=F.floor(h / 10))
    n = F.size("_words")
    a = (F.col("_g") % F.greatest(n, F.lit(1))).cast("int")
    p = (F.floor((n - a) / (3 + F.col("_g") % 8)) + 1).cast("int")
    often = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("_words", a + 1, p), often)), F.lit(1), n - a)
    made = F.when(n > 0, F.array_join(F.concat(F.slice("_words", F.lit(1), a), tail), " "))
    return cut.withColumn(text, F.coalesce(made, F.col(quoted(text)))).drop("_words", "_g")
