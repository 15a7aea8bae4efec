"""Runs of repeated words against a brute-force search."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import periods


def brute(words):
    """Every maximal stretch with a smallest period, by comparing all lags and all shorter periods."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length, stretch = j - i + q, words[i : j + q]
            if length >= max(6, 4 * q) and not any(stretch[:-r] == stretch[r:] for r in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def together(texts):
    """Runs of each text, found in all of them laid end to end."""
    numbers, parts, starts = {}, [], [0]
    for i, words in enumerate(texts):
        parts += [np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64), np.array([-1 - i])]
        starts.append(starts[-1] + len(words) + 1)
    found = [[] for _ in texts]
    for start, length, q in periods.find_word_runs(np.concatenate(parts), np.array(starts)):
        i = int(np.searchsorted(starts, start, "right")) - 1
        found[i].append((start - starts[i], length, q))
    return found


def made_up(rnd):
    """Stretches of all kinds of periods, some nested, some with a word changed, among random words."""
    kinds, out = rnd.choice([1, 2, 2, 3, 50]), []
    for _ in range(rnd.randint(0, 6)):
        if rnd.random() < 0.3:
            out += [rnd.randrange(kinds) for _ in range(rnd.randint(0, 60))]
            continue
        q = rnd.randint(1, 90)
        base = [rnd.randrange(kinds) for _ in range(q)]
        if rnd.random() < 0.4 and q > 3:
            inner = rnd.randint(1, 3)
            base = (base[:inner] * q)[:q]
        if rnd.random() < 0.3:
            base[-1] = 99
        out += (base * 8)[: rnd.randint(q, q * 7)]
    return out


@pytest.mark.parametrize("seed", range(25))
def test_texts_laid_end_to_end(seed):
    rnd = random.Random(seed)
    texts = [made_up(rnd) for _ in range(8)]
    assert together(texts) == [brute(t) for t in texts]


@given(st.lists(st.integers(0, 1), max_size=200), st.integers(1, 70), st.integers(4, 8))
@settings(max_examples=150, deadline=None)
def test_two_words_and_a_repeated_stretch(noise, q, times):
    words = noise[:50] + (noise[50 : 50 + q] or [1]) * times + noise[100:]
    assert together([words]) == [brute(words)]


@pytest.mark.parametrize("q", [15, 16, 17, 31, 32, 33, 63, 64, 100, 255, 256, 257])
@pytest.mark.parametrize("more", [-1, 0, 1])
def test_around_the_scales(q, more):
    """Exactly four periods, one word less and one more, of words that all differ."""
    words = [1000, 1001] + (list(range(q)) * 5)[: 4 * q + more] + [2000]
    assert together([words]) == [[(2, 4 * q + more, q)] if more >= 0 else []]


def test_words_without_structure_and_structure_without_runs():
    thue = [bin(i).count("1") % 2 for i in range(3000)]  # no stretch is repeated three times
    assert together([thue, list(range(3000)), [1] * 5, [1] * 6]) == [[], [], [], [(0, 6, 1)]]


def test_odd_tables(spark):
    long = "a b c d e f g h i j k l m n o p q r s t " * 50_000
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", None), (None, "a b " * 3, "x"), (4, "a\x0bb\xa0c " * 6 + "z", "x"), (5, long, "x"), (5, "no no no no no", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, RUNS string").unionByName(spark.createDataFrame([(6, "é é é é é é", "x")] * 2, "doc_id bigint, text string, RUNS string"))
    out = periods.periodic_runs(docs)
    assert out.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = {r["doc_id"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.filter("text IS NULL OR NOT startswith(text, 'no')").collect()}
    assert got[1] == got[2] == got[3] == (0, [], "")
    assert got[None] == (6, [], "a b a b a b")
    assert got[4] == (13, [(0, 12, 2)], "a b\xa0c z")
    assert got[5] == (1_000_000, [(0, 1_000_000, 20)], long[:39])
    assert got[6] == (6, [(0, 6, 1)], "é") and out.count() == 9
    assert periods.periodic_runs(docs.filter("1 = 0")).count() == 0


def test_the_query_against_brute_force(spark):
    import hashlib
    import zlib

    from paperloom.llm.queries import QUERIES, table

    sf, sha = "/root/testdata/sf0.001", lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for doc_id, text in table(spark, sf, "documents").select("doc_id", "text").collect():
        words, h = periods.WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = together([words])[0] if n > 1500 else brute(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        milli = 1000 * top[1] // top[2] if runs else None
        want[doc_id] = (len(runs), *top, milli, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op13_periods"](spark, sf).collect()}
    assert got == want and any(v[0] for v in want.values())
