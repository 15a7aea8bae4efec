from collections import Counter
from itertools import groupby
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.llm import language
from paperloom.llm.language import Profiles, count_ngrams, held_out, identify_language, learn_profiles
from paperloom.llm.queries import QUERIES


def brute(text):
    grams = Counter()
    for word in ("".join(g) for letters, g in groupby(text.lower(), key=str.isalpha) if letters):
        grams.update(word)
        word = "\x00" + word + "\x00"
        grams.update(word[i : i + n] for n in (2, 3) for i in range(len(word) - n + 1))
    return {sum((ord(c) + 1 if c != "\x00" else 1) << (21 * i) for i, c in enumerate(g)): n for g, n in grams.items()}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abÄß é1!\n中İ")), max_size=40))
def test_counts_equal_brute_force(text):
    keys, counts = count_ngrams(text)
    assert dict(zip(keys.tolist(), counts.tolist())) == brute(text)


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = "ein Wort, zwei Wörter " * 50
    whole = brute(text)
    for block in (1, 7, 64):
        monkeypatch.setattr(language, "BLOCK", block)
        keys, counts = count_ngrams(text)
        assert dict(zip(keys.tolist(), counts.tolist())) == whole


def test_distance_is_out_of_place():
    def key(c):
        return ord(c) + 1

    profiles = Profiles({"x": [key("a"), key("b"), key("c")], "y": [key("c"), key("b")]}, 3)
    # a text's own profile: " a", "a", "a "? keys of one letter only are looked at here
    ranks = profiles.ranks[np.searchsorted(profiles.keys, [key("a"), key("b"), key("c")])]
    assert ranks.tolist() == [[0, -1], [1, 1], [2, 0]]
    assert profiles.predict("") == ("und", 0.0) and profiles.predict(None) == ("und", 0.0) and profiles.predict("12 !") == ("und", 0.0)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    told = QUERIES["op5_language"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = told.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in tested) / len(tested) > 0.97


def test_odd_rows(odd, none):
    profiles = learn_profiles(odd.filter(~held_out()))
    assert profiles.langs and "fr" not in profiles.langs  # its only text is empty
    out = identify_language(odd.withColumn("SCORE", F.lit("x")), profiles)
    assert out.columns == [*odd.columns, "lang_pred", "score"]
    got = {r["doc_id"]: r for r in out.filter("doc_id IS NOT NULL").collect()}
    assert out.count() == odd.count()
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (3, 4, 5, 7))
    assert got[6]["lang_pred"] == "en"
    assert odd.filter(held_out() & F.col("doc_id").isNull()).count() == 2
    nothing = learn_profiles(none)
    assert nothing.langs == [] and {r["lang_pred"] for r in identify_language(odd, nothing).collect()} == {"und"}
    assert identify_language(none, profiles).count() == 0


def test_predictions_equal_brute_force(spark, odd):
    """Profiles, out-of-place distances and ties by plain counting, over learned and over given rows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = [r for r in docs.collect()]
    size = 300
    grams = {lang: Counter() for lang in {r["lang"] for r in rows} - {None}}
    for r in rows:
        if r["lang"] is not None and r["text"] is not None and crc32(str(r["doc_id"]).encode()) % 5:
            grams[r["lang"]].update(brute(r["text"]))
    top = lambda counts: [k for k, _ in sorted(counts.items(), key=lambda g: (-g[1], g[0]))[:size]]
    places = {lang: {k: i for i, k in enumerate(top(c))} for lang, c in grams.items() if c}

    def told(text):
        own = top(Counter(brute(text or "")))
        if not own:
            return "und", 0.0
        apart = {lang: sum(abs(at[k] - i) if k in at else size for i, k in enumerate(own)) for lang, at in places.items()}
        best = min(sorted(apart), key=apart.get)
        return best, 1 - apart[best] / (size * len(own))

    got = {r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in QUERIES["op5_language"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {r["doc_id"]: (lambda t: (t[0], round(t[1], 9)))(told(r["text"])) for r in rows}
