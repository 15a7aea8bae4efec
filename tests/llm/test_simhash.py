import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from paperloom.llm import simhash
from paperloom.llm.components import connected_components, spanning
from paperloom.llm.simhash import drop_near_duplicates, fingerprint, link_fingerprints, simhash_components


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_fingerprint_equals_definition():
    for text in ["", " \t", "One", "a b c", "a b  c\nD", "x y z " * 50 + "É Ä", "\xa0a b\x1cc d e f"]:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
        assert fingerprint(text) & (2**64 - 1) == want
    assert fingerprint(None) == 0


def test_sparks_hash_is_the_same(spark):
    row = spark.createDataFrame([("one two three fóur",)], "s string").select(F.xxhash64("s")).first()
    assert row[0] == fingerprint("One two  THREE fóur")


@pytest.mark.parametrize("bucket", [1024, 4])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, bucket):
    """Clusters, chains and a crowd of flipped bits; the small bucket sends them over common neighbours."""
    rnd = random.Random(5)
    values = {rnd.getrandbits(64) for _ in range(150)}
    for _ in range(12):
        at = rnd.getrandbits(64)
        for _ in range(rnd.randint(2, 15)):
            for bit in rnd.sample(range(64), rnd.randint(1, 6)):
                at ^= 1 << bit
            values.add(at)
    center = rnd.getrandbits(64)
    values |= {center ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(40)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    want = roots(len(values), [(i, j) for i in range(len(values)) for j in range(i) if ((values[i] ^ values[j]) & (2**64 - 1)).bit_count() <= 4])
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    df = spark.createDataFrame([(v,) for v in values], "f bigint")
    found = [tuple(r) for r in link_fingerprints(df).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 64 for a, b in found)
    at = {v: i for i, v in enumerate(values)}
    assert roots(len(values), [(at[a], at[b]) for a, b in found]) == want
    assert len(found) < 64 * len(values) or bucket == 4


def test_long_keys_meet_a_crowd_of_one_short_key(spark, monkeypatch):
    """Values that share 24 bits and no more are told apart by long keys; no neighbours are made."""
    rnd = random.Random(8)
    values = {(0xABCDEF << 40) | rnd.getrandbits(40) for _ in range(300)}
    for at in list(values)[:40]:
        for _ in range(3):
            for bit in rnd.sample(range(64), rnd.randint(1, 4)):
                at ^= 1 << bit
            values.add(at)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    want = roots(len(values), [(i, j) for i in range(len(values)) for j in range(i) if ((values[i] ^ values[j]) & (2**64 - 1)).bit_count() <= 4])
    monkeypatch.setattr(simhash, "BUCKET", 24)
    asked = []
    monkeypatch.setattr(simhash, "long_chain_keys", lambda value, keys=simhash.long_chain_keys: asked.append(1) or keys(value))
    monkeypatch.setattr(simhash, "_neighbours", lambda batches: 1 / 0)
    df = spark.createDataFrame([(v,) for v in values], "f bigint")
    at = {v: i for i, v in enumerate(values)}
    assert roots(len(values), [(at[r["a"]], at[r["b"]]) for r in link_fingerprints(df).collect()]) == want and asked


def test_long_keys_are_as_defined(spark):
    """Against the bits of the turned value, segment by segment; close values share one from a strong start."""
    rnd = random.Random(3)
    values = [0, -1, 1, -(1 << 63), *(rnd.getrandbits(64) - (1 << 63) for _ in range(6))]
    rows = spark.createDataFrame([(v,) for v in values], "f bigint").select("f", simhash.long_chain_keys(F.col("f")).alias("k")).collect()
    for r in rows:
        digits = format(r["f"] & (2**64 - 1), "016x")
        want = []
        for start in range(16):
            chain = (digits[start:] + digits[:start])[:11]
            for dropped in simhash._LEFT_OUT:
                want.append("".join("0" if i in dropped else c for i, c in enumerate(chain)))
        assert [format(k & ((1 << 44) - 1), "011x") for k in r["k"]] == want
        assert [k >> 44 for k in r["k"]] == list(range(352))


def test_components_agree_with_brute_force(spark):
    rnd = random.Random(1)
    n = 300
    links = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(220)] + [(i, i + 1) for i in range(200, 299)] + [(0, i) for i in range(1, 40)]
    df = spark.createDataFrame([*links, (None, 3), (5, 5), (7, None)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    want = roots(n, links)
    assert got == {i: want[i] for i in {x for e in links for x in e if e[0] != e[1]}}
    assert connected_components(df.filter("1 = 0")).count() == 0


def test_spanning_keeps_components():
    rnd = np.random.default_rng(2)
    a, b = rnd.integers(0, 400, 500), rnd.integers(0, 400, 500)
    x, y = spanning(a, b)
    assert len(x) < 400 and roots(400, zip(x.tolist(), y.tolist())) == roots(400, zip(a.tolist(), b.tolist()))


def test_odd_rows(odd, none):
    df = odd.withColumn("Fingerprint", F.lit("x")).withColumn("component_id", F.lit(0)).withColumn("_id", F.lit(0))
    out = simhash_components(df)
    rows = out.collect()
    assert len(rows) == odd.count()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add((r["fingerprint"], r["component_id"]))
    assert by_id[3] == by_id[4] == by_id[5] == {(0, 3)}  # no words
    assert by_id[1] == by_id[2] and next(iter(by_id[1]))[1] == 1
    assert by_id[None] == by_id[1] | {(0, 3)}  # null ids have their component, and are not its name
    assert len(by_id[7]) == 1
    assert simhash_components(none).count() == 0
    lone = odd.filter("doc_id IS NULL")
    assert {r["component_id"] for r in simhash_components(lone).collect()} == {None}


def test_one_document_of_each_group_stays(odd, none):
    df = odd.withColumn("_component", F.lit(0)).withColumn("root", F.lit(0))
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [-9, 1, 3, 6, 7, 8]
    assert drop_near_duplicates(none).count() == 0
    lone = drop_near_duplicates(odd.filter("doc_id IS NULL")).collect()
    assert len(lone) == 2 and {r["doc_id"] for r in lone} == {None}


def test_copies_beyond_the_broadcast_bound(odd, monkeypatch):
    monkeypatch.setattr(simhash, "MAX_BROADCAST_IDS", 0)
    assert sorted(r["doc_id"] for r in drop_near_duplicates(odd).collect()) == [-9, 1, 3, 6, 7, 8]
