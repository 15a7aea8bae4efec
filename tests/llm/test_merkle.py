"""Manifests against trees built in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from paperloom.llm import merkle


def joined(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(hashes):
    made = [hashes]
    while len(made[-1]) > 1:
        made.append([joined(*made[-1][i : i + 8]) for i in range(0, len(made[-1]), 8)])
    return made


def brute(rows, lie):
    """``key, leaf, subroot, root, siblings, folded, verified`` of rows ``key, group, text``."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append((row[0], joined(*map(part, row)), joined(*map(part, (*row[:2], lie(row))))))
    groups = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    for g in groups:
        trees[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    built = {g: levels([r[1] for r in trees[g]]) for g in groups}
    top = levels([built[g][-1][0] for g in groups])
    made = []
    for j, g in enumerate(groups):
        for i, (key, leaf, claim) in enumerate(trees[g]):
            siblings, now = "", claim
            for tree, at in ((built[g], i), (top, j)):
                for level in tree[:-1]:
                    run, k = level[at // 8 * 8 :][:8], at % 8
                    siblings += "".join(run[:k] + run[k + 1 :])
                    now, at = joined(*run[:k], now, *run[k + 1 :]), at // 8
            made.append((key, leaf, built[g][-1][0], top[-1][0], siblings, now, now == top[-1][0]))
    return sorted(made, key=repr)


def lie(row):
    """Every third row by its key's hash is claimed with another text."""
    return None if row[2] is None else row[2].lower() if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 else row[2]


def proved(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, lang string, text string, _leaf string, tree int")
    fields = [F.col(c) for c in ("doc_id", "lang", "text")]
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_hash([*fields[:2], F.lower("text")]))
    manifest = merkle.build_manifest(docs, merkle.leaf_hash(fields), claimed=claim)
    root = None if manifest.root is None else manifest.root.hex()
    got = merkle.prove(manifest).collect()
    return sorted(
        ((r["key"], bytes(r["leaf"]).hex(), bytes(r["subroot"]).hex(), root, bytes(r["siblings"]).hex(), bytes(r["folded"]).hex(), r["verified"]) for r in got), key=repr
    )


SETS = {
    "one row": [(1, "en", "A")],
    "one row a group": [(i, f"l{i}", "Text") for i in range(9)],
    "sizes around runs": [(100 * n + i, f"g{n:02d}", f"Text {i}") for n in (1, 2, 7, 8, 9, 16, 63, 64, 65) for i in range(n)],
    "one large group": [(i, "en", "Ä" * (i % 5)) for i in range(700)] + [(-1, "zz", None)],
    "nulls, ties and repeated rows": [(None, None, None), (None, None, "B"), (None, "", "B"), (3, "en", "C"), (3, "en", "C"), (3, "en", "D"), (4, None, "")],
    "groups by bytes": [(i, g, "T") for i, g in enumerate(["é", "z", "Z", "", None, "￮", "😀", "aa", "a"] * 2)],
    "a long text": [(i, "en", "Word " * 300_000) for i in range(3)],
}


@pytest.mark.parametrize("name", SETS)
def test_against_plain_trees(spark, name):
    rows = SETS[name]
    assert proved(spark, rows) == brute(rows, lie)


def test_an_empty_table(spark):
    assert proved(spark, []) == []


@pytest.mark.parametrize("room", [0, 3, 12, 90])
def test_lower_levels_by_shuffle(spark, room, monkeypatch):
    """The same proofs however many of the levels are held in every task."""
    monkeypatch.setattr(merkle, "MAX_UPPER_NODES", room)
    rows = SETS["one large group"] + SETS["sizes around runs"]
    assert proved(spark, rows) == brute(rows, lie)


def test_the_row_limit_is_put_back(spark):
    before = spark.conf.get(merkle._LIMIT, None)
    with merkle._any_rows(spark):
        assert spark.conf.get(merkle._LIMIT) == "-1"
    assert spark.conf.get(merkle._LIMIT, None) == before


def test_the_climb_is_a_recursive_query(spark, monkeypatch):
    plans = []
    real = merkle.stage
    monkeypatch.setattr(merkle, "stage", lambda df, name: plans.append((name, df._jdf.queryExecution().toString())) or real(df, name))
    proved(spark, SETS["sizes around runs"])
    assert any(n == "merkle-climb" and "UnionLoop" in p for n, p in plans)
