import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import neighbours, vector_copies
from paperloom.llm.neighbours import Hashes, nearest, probe_order
from paperloom.llm.vector_copies import vector_components

BAD = [(901, None), (902, [0.0] * 8), (903, [float("nan")] * 8), (904, [1.0] * 7 + [None]), (905, [float("inf")] + [0.0] * 7), (906, [1.0] * 5), (None, [1.0] * 8), (907, [])]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def drawn(n, d=8, seed=0):
    return np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)


def exact(ids, vectors, query, k):
    scores = (vectors.astype(np.float64) * vectors[query].astype(np.float64)).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]]
    return [(int(ids[i]), float(scores[i])) for i in order[:k]]


@pytest.mark.parametrize("rows, queries", [(8192, 32768), (40, 7)])
def test_recall_with_unequal_lengths(spark, monkeypatch, rows, queries):
    """Small groups split buckets and queries over many tasks, with the same result."""
    monkeypatch.setattr(neighbours, "GROUP_ROWS", rows)
    monkeypatch.setattr(neighbours, "GROUP_QUERIES", queries)
    vectors = drawn(600) * np.linspace(0.5, 1.5, 600, dtype=np.float32)[:, None]
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)] + BAD)
    got = {}
    for r in nearest(df, df.filter("vec_id % 20 = 0"), 10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 600, 20))
    hits = 0
    for query, found in got.items():
        want = exact(np.arange(600), vectors, query, 10)
        found = sorted(found)
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(s == pytest.approx(dict(exact(np.arange(600), vectors, query, 599))[v], abs=1e-12) for _, v, s in found)
        hits += len({v for _, v, _ in found} & {v for v, _ in want})
    assert hits / 300 >= 0.9


def test_every_bucket_is_exact(spark):
    vectors = drawn(100)
    vectors /= np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    vectors[50:60] = vectors[3]  # ties go to the smaller id
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])
    rows = nearest(df, df.filter("vec_id IN (3, 7)"), 20, target=1.0).orderBy("query_id", "rank").collect()
    for query in (3, 7):
        got = [r["vec_id"] for r in rows if r["query_id"] == query]
        assert got == [v for v, _ in exact(np.arange(100), vectors, query, 20)]
    assert [r["vec_id"] for r in rows if r["query_id"] == 3][:10] == list(range(50, 60))


def test_few_candidates_and_empty_tables(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])]).withColumn("score", F.lit("x")).withColumn("bucket", F.lit(1))
    got = [(r["rank"], r["vec_id"], r["score"]) for r in nearest(df, df.filter("vec_id = 0"), 20, target=1.0).orderBy("rank").collect()]
    assert got == [(1, 1, 0.0), (2, 2, -1.0)]
    assert nearest(df.filter("1 = 0"), df, 20).count() == 0
    assert nearest(df, df.filter("1 = 0"), 20).count() == 0
    assert nearest(frame(spark, BAD[:3]), frame(spark, BAD[:3]), 20).count() == 0


def test_probes_come_in_order_of_success():
    hashes = Hashes.drawn(4, 1, 2, 1.0, 1.0, 0)
    cells = np.array([[x, y] for x in range(-3, 3) for y in range(-3, 3)])
    codes = Hashes.code(cells)
    assert (Hashes.cells(codes, 2) == cells).all()
    places = np.array([[0.5, 0.5]])
    one = probe_order(places, codes, 0.5, hashes.width, 0.01)
    assert cells[one[0]].tolist() == [[0, 0]]
    few = probe_order(places, codes, 0.5, hashes.width, 0.8)
    assert few[0].sum() < 10 and few[0][(cells == 0).all(axis=1)].all()
    assert probe_order(places, codes, 0.5, hashes.width, 1.0).all()


def copies(n=400, d=16, seed=3):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, d))
    vectors[100:160] = vectors[5] + rng.normal(size=(60, d)) * 0.05
    vectors[200:210] = vectors[8]  # exact
    for i in range(300, 320):  # a chain
        vectors[i] = vectors[i - 1] + rng.normal(size=d) * 0.15
    return vectors.astype(np.float32)


def brute(vectors, threshold=0.95):
    v = vectors.astype(np.float64)
    cosines = (v @ v.T) / np.sqrt((v * v).sum(axis=1)[:, None] * (v * v).sum(axis=1)[None, :])
    met = (cosines >= threshold) & ~np.eye(len(v), dtype=bool)
    root = np.arange(len(v))
    while True:
        low = np.minimum(root, np.where(met, root[None, :], len(v)).min(axis=1))
        if (low == root).all():
            return met.sum(axis=1), root
        root = low


@pytest.mark.parametrize("block", [2048, 13])
def test_components_agree_with_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vector_copies, "BLOCK", block)
    vectors = copies()
    ids = np.arange(len(vectors)) * 3
    df = frame(spark, [(int(i), v.tolist()) for i, v in zip(ids, vectors)] + BAD)
    rows = {r["vec_id"]: r for r in vector_components(df, leaf=60).collect()}
    links, root = brute(vectors)
    got = np.array([rows[int(i)]["n_links"] for i in ids])
    assert (got <= links).all() and got.sum() >= 0.97 * links.sum()
    assert sum(rows[int(i)]["component_id"] == ids[r] for i, r in zip(ids, root)) >= 0.98 * len(ids)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows.values() if r["vec_id"] is not None)
    for vec_id, _ in BAD:
        assert (rows[vec_id]["n_links"], rows[vec_id]["component_id"], rows[vec_id]["kept"]) == (0, vec_id, True)


def test_one_leaf_is_exact(spark):
    vectors = copies()[:165]
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])
    links, root = brute(vectors)
    rows = sorted(tuple(r) for r in vector_components(df).collect())
    assert rows == [(i, int(n), int(r), bool(i == r)) for i, (n, r) in enumerate(zip(links, root))]


def test_odd_tables(spark):
    df = frame(spark, [(4, [1.0, 0.0]), (4, [1.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, -0.0]), (9, [0.0, 1e-30]), (8, [-0.0, 1e-30])])
    df = df.withColumn("node", F.lit(1)).withColumn("Kept", F.lit("x")).withColumn("leaf", F.lit(0))
    rows = sorted(tuple(r) for r in vector_components(df).collect())
    assert rows == [(2, 2, 2, True), (3, 0, 3, True), (4, 2, 2, False), (4, 2, 2, False), (8, 1, 8, True), (9, 1, 8, False)]
    assert vector_components(df.filter("1 = 0")).count() == 0
    assert vector_components(frame(spark, BAD[:2])).count() == 2


def one_cluster(n, d, cosine, seed=4):
    """Unit vectors, the first third of them one cluster of pairs with about this cosine."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.sqrt((x * x).sum(axis=-1, keepdims=True))
    vectors = unit(rng.normal(size=(n, d)))
    vectors[: n // 3] = cosine**0.5 * unit(rng.normal(size=d)) + (1 - cosine) ** 0.5 * vectors[: n // 3]
    return unit(vectors)


@pytest.mark.parametrize("share", [1, 10])
def test_trees_keep_a_large_cluster_together(share):
    """Near copies that fill many leaves are not parted; the sample holds all rows or a tenth."""
    vectors = one_cluster(12_000, 64, 0.96)
    rng = np.random.default_rng(5)
    forest = vector_copies.Forest.fitted(vectors[rng.permutation(12_000)[: 12_000 // share]], 12_000, 8, 100, 0.1, 0)
    row, leaf = forest.assign(vectors[:4_000])
    sets = [set(s.tolist()) for s in np.split(leaf, np.searchsorted(row, np.arange(1, 4_000)))]
    a, b = rng.integers(0, 4_000, (2, 5_000))
    near = (vectors[a] * vectors[b]).sum(axis=1) >= 0.95
    assert near.sum() > 4_000
    assert np.mean([bool(sets[p] & sets[q]) for p, q in zip(a[near], b[near])]) >= 0.99
    assert forest.leaves > 8 * 10  # the rest is still cut


def test_large_cluster_is_met_once(spark, monkeypatch):
    """A leaf of many blocks: every link is counted once, and later trees do not meet it again."""
    monkeypatch.setattr(vector_copies, "BLOCK", 64)
    vectors = one_cluster(1_500, 32, 0.97).astype(np.float32)
    links, root = brute(vectors)
    rows = sorted(tuple(r) for r in vector_components(frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]), leaf=60).collect())
    got = np.array([r[1] for r in rows])
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum()
    assert [r[2] for r in rows] == root.tolist()


def test_rows_that_met_do_not_meet_again(monkeypatch):
    monkeypatch.setattr(vector_copies, "BLOCK", 10)
    # rows 0 to 99 share leaf 0; they and rows 100 to 119 share leaf 1
    row = np.r_[np.repeat(np.arange(100), 2), np.arange(100, 120)]
    leaf = np.r_[np.tile([0, 1], 100), np.ones(20, np.int64)]
    home = vector_copies.Blocks.homes(row, leaf, np.array([True, True]))
    assert home.tolist() == [0] * 200 + [1] * 20
    blocks = vector_copies.Blocks.of(np.array([100, 120]), [(2, 100)])
    again, own, other = blocks.dealt(row, leaf, row * 7919)
    met = {}
    for at, low, high, mine in zip(again, np.minimum(own, other), np.maximum(own, other), own):
        met.setdefault((leaf[at], low, high), {}).setdefault(mine, []).append(row[at])
    pairs = []
    for (where, low, high), sides in met.items():
        left, right = sides.get(low, []), sides.get(high, [])
        pairs += [(where, *sorted((p, q))) for i, p in enumerate(left) for q in (left[i + 1 :] if low == high else right)]
    assert len(pairs) == len(set(pairs))
    assert {p[1:] for p in pairs if p[0] == 0} == {(p, q) for p in range(100) for q in range(p + 1, 100)}
    assert {p[1:] for p in pairs if p[0] == 1} == {(p, q) for p in range(120) for q in range(p + 1, 120) if q >= 100}


@pytest.mark.parametrize("usual", [None, 0.01])
def test_recall_beside_groups_of_copies(spark, monkeypatch, usual):
    """Queries without copies reach the target too, even if no sampled query told their distance."""
    if usual:
        monkeypatch.setattr(neighbours, "_usual_distance", lambda *_: usual)
    vectors = drawn(3000, 64, 6)
    vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    vectors[:1800] = np.repeat(vectors[:30], 60, axis=0) + drawn(1800, 64, 7) * np.float32(1e-4)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])
    got = {}
    for r in nearest(df, df.filter("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = np.array([len(got[q] & {v for v, _ in exact(np.arange(3000), vectors, q, 20)}) / 20 for q in range(0, 3000, 20)])
    assert recall[:90].mean() >= 0.9 and recall[90:].mean() >= 0.9, (recall[:90].mean(), recall[90:].mean())
