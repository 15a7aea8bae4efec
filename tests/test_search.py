import math
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.operators import chunking, embedding, retrieval, search
from paperloom.operators import ingest as ingesting
from paperloom.operators.answers import answer, answer_extractive, build_context, n_citations
from paperloom.operators.ingest import diff_ingest, ingest, ingest_report, load_index, refresh_chunks, refresh_index
from paperloom.operators.invoke import make_stub
from paperloom.operators.search import top_k
from paperloom.staging import stage_path
from paperloom.functions.policy import Policy


@pytest.mark.parametrize("n", [0, 1, 15, 285, 300, 301, 585, 586, 700])
def test_chunk_fixed_sizes(spark, n):
    words = [f"w{i}" for i in range(n)]
    chunks = chunking.chunk_fixed(spark.createDataFrame([(7, " \n".join(words))], "doc_id long, text string")).orderBy("chunk_idx").collect()
    want = [words[i * 285 : i * 285 + 300] for i in range(max(1, math.ceil((n - 15) / 285)))] if n else []
    assert [c["text"].split() for c in chunks] == want
    assert [c["chunk_id"] for c in chunks] == [f"7#{i}" for i in range(len(want))]
    assert all(c["n_tokens"] == len(w) <= 300 for c, w in zip(chunks, want))


def test_chunks_join_back_to_the_text(spark):
    text = " ".join(f"t{i}" for i in range(1234))
    chunks = chunking.chunk_fixed(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("chunk_idx").collect()
    joined = chunks[0]["text"].split() + [w for c in chunks[1:] for w in c["text"].split()[15:]]
    assert " ".join(joined) == text


def test_hierarchical_children_lie_in_their_parent(spark):
    docs = spark.createDataFrame([(1, " ".join(f"t{i}" for i in range(2500)))], "doc_id long, text string")
    kids = chunking.chunk_hierarchical(docs).collect()
    parents = {k["parent_id"] for k in kids}
    assert parents == {"1#0", "1#1", "1#2"}
    assert all(k["n_tokens"] <= 500 for k in kids)
    first = sorted((k["child_idx"], k["text"].split()[0]) for k in kids if k["parent_id"] == "1#1")
    assert first == [(0, "t950"), (1, "t1400"), (2, "t1850")]


def test_semantic_cuts_at_the_change_of_subject(spark):
    cats = "cats purr and cats sleep. " * 6
    cars = "engines burn fuel and engines roar. " * 6
    docs = spark.createDataFrame([(1, cats + cars), (2, "One. Two."), (3, "")], "doc_id long, text string")
    got = [(r["doc_id"], r["text"]) for r in chunking.chunk_semantic(docs).orderBy("doc_id", "segment", "part").collect()]
    assert got[-1] == (2, "One. Two.")
    first = [t for d, t in got if d == 1]
    assert len(first) >= 2 and "engines" not in first[0] and " ".join(first).split() == (cats + cars).split()


def _vectors(spark, n, dim=8, key="chunk_id", seed=1):
    rng = np.random.default_rng(seed)
    rows = [(f"c{i:03d}", [float(x) for x in rng.integers(-2, 3, dim)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, f"{key} string, embedding array<float>")


def _brute(chunks, asked, k, metric):
    out = []
    for q, v in asked:
        v = np.array(v)
        scored = []
        for c, w in chunks:
            w = np.array(w)
            if metric == "euclidean":
                s = float(np.linalg.norm(v - w))
            else:
                s = float(v @ w)
                if metric == "cosine":
                    norm = np.linalg.norm(v) * np.linalg.norm(w)
                    s = s / norm if norm else 0.0
            scored.append((round(s, 6) if metric == "euclidean" else -round(s, 6), c))
        for rank, (s, c) in enumerate(sorted(scored)[:k], 1):
            out.append((q, rank, c, s if metric == "euclidean" else -s))
    return out


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
@pytest.mark.parametrize("bounds", [{}, {"max_queries": 4}, {"max_cells": 10}])
def test_top_k_is_exact(spark, metric, bounds):
    """Small whole numbers give many ties; they break by chunk id."""
    chunks, index = _vectors(spark, 150)
    asked, queries = _vectors(spark, 11, key="query_id", seed=2)
    got = sorted((tuple(r) for r in top_k(index.repartition(5), queries, 4, metric, **bounds).collect()), key=lambda r: (r[0], r[1]))
    want = _brute(chunks, asked, 4, metric)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-6)


@pytest.mark.parametrize("bounds", [{}, {"max_queries": 1}])
def test_top_k_sparse_and_min_score(spark, bounds):
    index = spark.createDataFrame(
        [("a", [1, 5], [0.6, 0.8]), ("b", [2], [1.0]), ("c", [5], [1.0]), ("d", [], [])], "chunk_id string, buckets array<int>, weights array<double>"
    )
    queries = spark.createDataFrame([(1, [5, 9], [0.6, 0.8]), (2, [7], [1.0])], "query_id long, buckets array<int>, weights array<double>")
    got = sorted(tuple(r) for r in top_k(index, queries, 3, "dot", min_score=0.0, **bounds).collect())
    assert got == [(1, 1, "c", 0.6), (1, 2, "a", 0.48)]


def test_top_k_without_questions(spark):
    _, index = _vectors(spark, 3)
    assert top_k(index, index.withColumnRenamed("chunk_id", "query_id").limit(0)).count() == 0


def test_ranks_have_no_gap_and_scores_fall(spark):
    _, index = _vectors(spark, 60)
    got = top_k(index, index.withColumnRenamed("chunk_id", "query_id"), 5).orderBy("query_id", "rank").collect()
    for i in range(0, len(got), 5):
        five = got[i : i + 5]
        assert [r["rank"] for r in five] == [1, 2, 3, 4, 5]
        assert all(-1 <= r["score"] <= 1 for r in five) and [r["score"] for r in five] == sorted((r["score"] for r in five), reverse=True)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_cells_are_exact_and_skip_cells(spark, tmp_path, metric):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(12, 6)) * 10
    rows = [(f"c{i:03d}", [float(x) for x in middles[i % 12] + rng.normal(size=6) * 0.1]) for i in range(240)]
    vectors = spark.createDataFrame(rows, "chunk_id string, embedding array<float>")
    queries = vectors.filter("chunk_id < 'c006'").withColumnRenamed("chunk_id", "query_id")
    cells = retrieval.Cells.build(vectors, str(tmp_path / metric), 24, metric=metric, cell_rows=20)
    got = sorted(tuple(r) for r in cells.search(queries, 3, n_probe=1).collect())
    assert got == sorted(tuple(r) for r in top_k(vectors, queries, 3, metric).collect())
    assert len(cells.last_read[0]) + len(cells.last_read[1]) < 24


def test_validate_vectors(spark):
    good = [1.0, 2.0]
    rows = [(1, good), (2, [1.0]), (3, None), (4, [float("nan"), 1.0]), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [float("inf"), 1.0])]
    accepted, rejected = embedding.validate_vectors(spark.createDataFrame(rows, "i long, embedding array<float>"), 2)
    assert [r["i"] for r in accepted.collect()] == [1]
    assert {r["i"]: r["fault"] for r in rejected.collect()} == {
        2: "wrong size", 3: "missing", 4: "not finite", 5: "zero norm", 6: "null value", 7: "not finite"
    }


def test_cosine_and_distance(value):
    a, b = F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(4.0), F.lit(-3.0))
    assert value(embedding.cosine(a, a)) == 1.0 and value(embedding.cosine(a, b)) == 0.0
    assert value(embedding.cosine(a, F.array(F.lit(0.0), F.lit(0.0)))) is None
    assert value(embedding.euclidean(a, b)) == pytest.approx(math.sqrt(50))


def test_dense_form_matches_sparse(spark):
    docs = spark.createDataFrame([(1, "a b b c")], "i long, text string")
    row = embedding.embed_hash(docs, ["i"]).withColumn("dense", embedding.to_dense(F.col("buckets"), F.col("weights"))).first()
    assert len(row["dense"]) == 1024 and sum(x * x for x in row["dense"]) == pytest.approx(1.0)
    assert [i for i, x in enumerate(row["dense"]) if x] == list(row["buckets"])


def _weights(df):
    return {(r["i"], b): round(w, 6) for r in df.collect() for b, w in zip(r["buckets"], r["weights"])}


def test_vectors_beyond_the_broadcast_bound_are_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"common word{i % 50} only{i} common") for i in range(2000)], "i long, text string")
    idf = embedding.term_idf(docs, 2000)
    small = _weights(embedding.embed_hash(docs, ["i"], idf=idf, n_chunks=2000))
    monkeypatch.setattr(embedding, "MAX_BROADCAST_TERMS", 10)
    large = embedding.embed_hash(docs, ["i"], idf=idf, n_chunks=2000)
    assert _weights(large) == small and len(small) > 4000


def test_vectors_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b a unknown"), (2, "!"), (3, None), (4, "b")], "i long, text string")
    idf = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 3.0), ("c", 1, 9.0)], "term string, df long, idf double")
    got = {r["i"]: dict(zip(r["buckets"], r["weights"])) for r in embedding.embed_hash(docs, ["i"], idf=idf).collect()}
    bucket = {r["term"]: r["b"] for r in idf.select("term", embedding.term_bucket(F.col("term")).alias("b")).collect()}
    assert got == {1: {bucket["a"]: pytest.approx(0.8), bucket["b"]: pytest.approx(0.6)}, 4: {bucket["b"]: 1.0}}


def test_embedding_within_bounds_shuffles_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "i long, text string")
    idf = spark.createDataFrame([("a", 1, 2.0)], "term string, df long, idf double")
    plan = embedding.embed_hash(docs, ["i"], idf=idf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_lexical_beyond_the_broadcast_bound_is_the_same(spark, index, monkeypatch):
    asked = _ask(spark, "hail collision coverage", "fire policy covers homes")
    small = sorted(map(tuple, retrieval.retrieve_lexical(asked, index, 3).collect()))
    monkeypatch.setattr(retrieval, "MAX_BROADCAST_TERMS", 2)
    assert sorted(map(tuple, retrieval.retrieve_lexical(asked, index, 3).collect())) == small and len(small) >= 3


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = [
        (1, "Collision coverage pays for impact with another car. Hail is not collision.", "AUTO"),
        (2, "Comprehensive coverage includes theft, fire and hail.", "AUTO"),
        (3, "The kitchen fire policy covers homes only.", "HOME"),
        (4, "...", "HOME"),
    ]
    path = str(tmp_path_factory.mktemp("index") / "i")
    ingest(spark.createDataFrame(docs, "doc_id long, text string, policy_type string"), path, ("policy_type",), "policy_type")
    return load_index(spark, path)


def _ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, question string")


def test_retrieve_and_filter(spark, index):
    asked = _ask(spark, "What does comprehensive coverage include?", "fire", "zzz unknown")
    got = {(r["query_id"], r["rank"]): r["chunk_id"] for r in retrieval.retrieve(asked, index, 2).collect()}
    assert got[(0, 1)] == "2#0" and {got[(1, 1)], got[(1, 2)]} == {"2#0", "3#0"} and not any(q == 2 for q, _ in got)
    homes = retrieval.retrieve(asked, index, 2, where=F.col("policy_type") == "HOME")
    assert {r["chunk_id"] for r in homes.collect()} == {"3#0"}
    plan = index.vectors.filter(F.col("policy_type") == "HOME")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(policy_type" in plan
    assert [r["chunk_id"] for r in retrieval.retrieve_one(index, "kitchen homes").collect()] == ["3#0"]


def test_hybrid_and_rerank(spark, index):
    asked = _ask(spark, "hail collision")
    assert [r["rank"] for r in retrieval.retrieve_hybrid(asked, index, 2).orderBy("rank").collect()] == [1, 2]
    found = retrieval.with_texts(retrieval.retrieve(asked, index, 3), index).drop("rank", "score").join(asked, "query_id")
    assert retrieval.rerank(found, 1).first()["chunk_id"] == "1#0"
    assert retrieval.rerank(found, 1, lambda q, t: float("theft" in t)).first()["chunk_id"] == "2#0"


def test_answers_cite_their_hits(spark, index):
    asked = _ask(spark, "Does collision pay for hail?", "nothing known here zzz")
    done = {r["query_id"]: r for r in n_citations(answer(asked, index, make_stub)).collect()}
    assert done[0]["n_citations"] == 2 or done[0]["n_citations"] == 3
    assert [c["rank"] for c in done[0]["citations"]] == list(range(1, done[0]["n_citations"] + 1))
    assert done[1]["citations"] == [] and done[1]["answer"].endswith("zzz")
    assert done[0]["answer"].endswith("Question: Does collision pay for hail?")


def test_policy_blocks_questions_before_retrieval(spark, index):
    asked = _ask(spark, "What legal action should I take?", "hail coverage")
    done = {r["query_id"]: r for r in answer(asked, index, make_stub, policy=Policy()).collect()}
    assert done[0]["action"] == "blocked" and done[0]["citations"] == [] and done[0]["answer"] == Policy().blocked_input
    assert done[1]["action"] == "none"
    assert {r["query_id"] for r in retrieval.retrieve_guarded(asked, index).collect()} == {1}


def test_extractive_answer_and_context(spark, index):
    asked = _ask(spark, "Is hail a collision?")
    hits = retrieval.with_texts(retrieval.retrieve(asked, index, 3), index)
    best = answer_extractive(asked, hits.drop("score")).first()
    assert best["answer"] == "Hail is not collision." and best["chunk_id"] == "1#0"
    prompt = build_context(hits, "Use: {text}").first()["prompt"]
    assert prompt.startswith("Use: [1] Collision coverage") and "\n[2] " in prompt


def test_diff_ingest(spark):
    schema = "doc_id long, text string"
    old = spark.createDataFrame([(1, "same"), (2, "before"), (3, "gone")], schema)
    new = spark.createDataFrame([(1, "same"), (2, "after"), (4, "same")], schema)
    diff = diff_ingest(old, new)
    assert {r["doc_id"]: r["status"] for r in diff.collect()} == {1: "unchanged", 2: "changed", 3: "removed", 4: "new"}
    assert {r["status"]: r["n_docs"] for r in ingest_report(diff).collect()} == {"unchanged": 1, "changed": 1, "removed": 1, "new": 1}
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert plan.index("sha2") > plan.index("Exchange")  # hashed below the shuffle


def test_refreshed_chunks_equal_a_full_rebuild(spark):
    schema = "doc_id long, text string"
    old = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "e")], schema)
    new = spark.createDataFrame([(1, "a b"), (2, "c d e"), (4, "f")], schema)
    chunks = refresh_chunks(chunking.chunk_fixed(old), new, diff_ingest(old, new))
    assert sorted(map(tuple, chunks.collect())) == sorted(map(tuple, chunking.chunk_fixed(new).collect()))


def test_best_parents_are_exact(spark, tmp_path):
    """Against the best child of every parent, scored one by one."""
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"w{j}" for j in rng.integers(0, 40, 60))) for i in range(12)]
    cut = partial(chunking.chunk_hierarchical, parent_tokens=10, child_tokens=4, overlap=1)
    index = ingest(spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path / "i"), chunker=cut)
    asked = _ask(spark, "w1 w2 w3", "w7 w9")
    every = retrieval.retrieve(asked, index, 10_000).collect()
    best = {}
    for r in every:
        parent = (r["query_id"], r["chunk_id"].rsplit("#", 1)[0])
        best[parent] = max(best.get(parent, 0.0), r["score"])
    want = {q: sorted((-s, p) for (q2, p), s in best.items() if q2 == q)[:4] for q in (0, 1)}
    got = retrieval.retrieve_parents(asked, index, 4).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["parent_id"], r["score"]) for r in got] == [(q, p, -s) for q in (0, 1) for s, p in want[q]]


def _parts_read(df):
    """What the file scans of a plan filter partitions by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "PartitionFilters" in line and "part" in line.split("PartitionFilters")[1].split("]")[0]]


def test_texts_and_postings_are_pruned(spark, index):
    """At question time only parts that hold a hit or a term are read, and no text is taken apart."""
    asked = _ask(spark, "hail collision")
    assert _parts_read(retrieval.with_texts(retrieval.retrieve(asked, index, 1), index))
    from paperloom.operators import search

    seen = []
    original = search.top_k
    try:
        retrieval.top_k = lambda chunks, *a, **b: seen.append(chunks) or original(chunks, *a, **b)
        retrieval.retrieve_lexical(asked, index, 2)
    finally:
        retrieval.top_k = original
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "text" not in plan
    assert _parts_read(seen[0])


def make_tiny_model():
    def model(texts):
        return [None if "absent" in t else [float("nan")] * 2 if "spoilt" in t else [float(len(t)), float(t.count("a"))] for t in texts]

    return model


def test_an_index_of_model_vectors(spark, tmp_path):
    docs = spark.createDataFrame([(1, "banana bread"), (2, "spoilt"), (3, "absent"), (4, "xyz")], "doc_id long, text string")
    index = ingest(docs, str(tmp_path / "i"), dim=2, make_model=make_tiny_model)
    assert dict(index.vectors.dtypes)["embedding"] == "array<float>"
    assert {(r["doc_id"], r["fault"]) for r in index.rejects.collect()} == {(2, "not finite"), (3, "missing")}
    hits = retrieval.retrieve(_ask(spark, "bananas", "spoilt", "zzz"), index, 2).collect()
    assert {h["query_id"] for h in hits} == {0, 2} and {h["chunk_id"] for h in hits} == {"1#0", "4#0"}
    assert next(h["chunk_id"] for h in hits if (h["query_id"], h["rank"]) == (2, 1)) == "4#0"
    with pytest.raises(ValueError):
        load_index(spark, str(tmp_path / "i"))
    again = load_index(spark, str(tmp_path / "i"), make_tiny_model)
    assert n_citations(answer(_ask(spark, "bananas"), again, make_stub)).first()["n_citations"] == 2


@pytest.mark.parametrize("model", [None, make_tiny_model])
def test_a_refreshed_index_equals_one_built_anew(spark, tmp_path, model):
    schema = "doc_id long, text string, lang string"
    old = spark.createDataFrame([(1, "same words", "en"), (2, "before this", "en"), (3, "gone words", "de"), (5, None, "en")], schema)
    new = spark.createDataFrame([(1, "same words", "en"), (2, "after that words", "en"), (4, "new words spoilt", "de"), (5, None, "en")], schema)
    options = dict(metadata=("lang",), dim=2 if model else 1024, make_model=model)
    first = ingest(old, str(tmp_path / "old"), **options)
    whole = ingest(new, str(tmp_path / "whole"), **options)
    fresh = refresh_index(first, new, diff_ingest(old, new), str(tmp_path / "fresh"))
    for name in ("chunks", "counts", "postings", "terms", "vectors"):
        a, b = getattr(fresh, name), getattr(whole, name)
        listed = lambda df: sorted(map(str, df.select(*b.columns).collect()))  # noqa: E731, B023
        assert listed(a) == listed(b) and listed(a), name
    assert (fresh.n_chunks, fresh.mean_terms, fresh.metadata) == (whole.n_chunks, whole.mean_terms, whole.metadata)


def test_blocks_of_questions_find_the_same(spark):
    rng = np.random.default_rng(3)
    vectors = spark.createDataFrame([(f"c{i:03d}", rng.normal(size=6).tolist()) for i in range(200)], "chunk_id string, embedding array<double>")
    asked = vectors.withColumnRenamed("chunk_id", "query_id")
    whole = sorted(map(tuple, top_k(vectors, asked, 3).collect()))
    assert sorted(map(tuple, top_k(vectors, asked, 3, max_queries=30).collect())) == whole
    assert sorted(map(tuple, top_k(vectors, asked, 3, max_queries=30, max_cells=13).collect())) == whole
    plan = top_k(vectors, asked, 3, max_queries=30)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan


def test_cells_serve_any_number_of_questions(spark, tmp_path):
    rng = np.random.default_rng(4)
    spots = rng.normal(size=(8, 5)) * 10
    vectors = spark.createDataFrame([(f"c{i:03d}", (spots[i % 8] + rng.normal(size=5) * 0.1).tolist()) for i in range(240)], "chunk_id string, embedding array<double>")
    asked = vectors.withColumnRenamed("chunk_id", "query_id")
    cells = retrieval.Cells.build(vectors, str(tmp_path / "c"), 8, metric="euclidean", cell_rows=10)
    whole = sorted(map(tuple, top_k(vectors, asked, 3, "euclidean").collect()))
    assert sorted(map(tuple, cells.search(asked, 3, n_probe=1, max_queries=40).collect())) == whole
    # a question meets a few cells, not every cell that some question needs
    assert sum(cells.last_pairs) < 8 * 40 / 2


def test_parents_of_many_children(spark, tmp_path):
    docs = [(i, " ".join(["w1 w2"] * 10 + [f"x{i}"] * 380)) for i in range(3)]
    cut = partial(chunking.chunk_hierarchical, parent_tokens=400, child_tokens=5, overlap=0)
    index = ingest(spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path / "i"), chunker=cut)
    assert retrieval.retrieve_parents(_ask(spark, "w1 w2"), index, 3).count() == 3


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_faulty_vectors_do_not_hide_others(spark, metric):
    good = [(f"g{i}", [float(i + 1), 1.0]) for i in range(6)]
    bad = [("n1", [float("nan"), 1.0]), ("n2", None), ("n3", [float("inf"), 0.0]), ("n4", [1.0, None]), ("n5", [])]
    index = spark.createDataFrame(good + bad, "chunk_id string, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([(0, [1.0, 0.0]), (1, [float("nan"), 0.0]), (2, None)], "query_id long, embedding array<double>")
    hits = top_k(index, asked, 3, metric).collect()
    assert len(hits) == 3 and {h["query_id"] for h in hits} == {0} and all(h["chunk_id"].startswith("g") for h in hits)


def test_long_questions_make_no_large_matrix(spark, monkeypatch):
    """Cells are counted before a matrix is made; beyond the bound blocks do it."""
    from paperloom.operators import search

    made = []
    of = search.QueryMatrix.of.__func__
    monkeypatch.setattr(search.QueryMatrix, "of", classmethod(lambda cls, *a: made.append(a) or of(cls, *a)))
    vectors = [(f"c{i}", [i % 7, 7 + i % 5], [1.0, 2.0]) for i in range(30)]
    index = spark.createDataFrame(vectors, "chunk_id string, buckets array<bigint>, weights array<double>")
    asked = index.withColumnRenamed("chunk_id", "query_id")
    got = top_k(index, asked, 2, "dot", max_cells=10)
    assert made and all(search._cells(a[0]) <= 10 for a in made)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, top_k(index, asked, 2, "dot").collect()))


def test_semantic_chunks_keep_metadata(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Cats purr. Dogs bark.", "en"), (2, "Chats dorment.", "fr")], "doc_id long, text string, lang string")
    index = ingest(docs, str(tmp_path / "i"), metadata=("lang",), chunker=chunking.chunk_semantic)
    assert retrieval.retrieve(_ask(spark, "chats"), index, 1, where=F.col("lang") == "fr").count() == 1


def test_status_of_null_texts(spark):
    old = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, None)], "doc_id long, text string")
    new = spark.createDataFrame([(1, None), (3, None), (4, "b"), (5, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["status"] for r in diff_ingest(old, new).collect()}
    assert got == {1: "unchanged", 2: "removed", 3: "changed", 4: "changed", 5: "new"}


def test_semantic_index(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Cats purr. Cats sleep. Engines roar. Engines burn fuel.")], "doc_id long, text string")
    index = ingest(docs, str(tmp_path / "i"), chunker=chunking.chunk_semantic)
    assert retrieval.retrieve(_ask(spark, "fuel"), index, 1).count() == 1


@pytest.mark.parametrize("buffer", [0, 1, 2])
def test_gap_distances_by_hand(spark, buffer):
    """Documents of a batch do not touch each other."""
    rng = np.random.default_rng(buffer)
    docs = [[[int(x) for x in rng.integers(0, 6, rng.integers(0, 5))] for _ in range(n)] for n in (0, 1, 2, 7, 3)] + [None]
    got = chunking.gap_distances(pa.array(docs, pa.list_(pa.list_(pa.int32()))), buffer).to_pylist()
    want = []
    for sents in docs:
        counts = [np.bincount(np.array(s, dtype=int), minlength=6) for s in sents or []]
        wide = [sum(counts[max(0, i - buffer) : i + buffer + 1]) for i in range(len(counts))]
        row = []
        for a, b in zip(wide, wide[1:]):
            norm = np.linalg.norm(a) * np.linalg.norm(b)
            row.append(1 - float(a @ b) / norm if norm else 1.0)
        want.append(pytest.approx(row))
    assert got == want


def test_questions_meet_vectors_of_their_own_length(spark):
    index = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [1.0, 0.0, 0.0]), ("c", [0.0, 1.0]), ("d", [1.0]), ("e", [])], "chunk_id string, embedding array<float>"
    )
    asked = lambda *vectors: spark.createDataFrame(list(enumerate(vectors)), "query_id long, embedding array<float>")
    hits = lambda q, **s: sorted((r["query_id"], r["rank"], r["chunk_id"]) for r in top_k(index, q, 3, **s).collect())
    assert hits(asked([1.0, 0.0])) == [(0, 1, "a"), (0, 2, "c")]
    assert hits(asked([1.0, 0.0, 0.0, 0.0])) == []
    both = asked([0.0, 1.0], [1.0, 1.0, 1.0], [2.0])
    assert hits(both) == hits(both, max_queries=2) == [(0, 1, "c"), (0, 2, "a"), (1, 1, "b"), (2, 1, "d")]
    with pytest.raises(ValueError):
        top_k(index, asked(*[[1.0] * n for n in range(1, 11)]))
    cells = retrieval.Cells.build(index, stage_path(spark, "cells"), n_cells=2)
    got = cells.search(both, 3).collect()
    assert {(r["query_id"], r["chunk_id"]) for r in got} == {(0, "a"), (0, "c")}


def test_blocks_that_cannot_matter_are_not_read(spark, tmp_path, monkeypatch):
    """A rare term tells what others must beat: few postings of the frequent ones are read, and the hits are the same."""
    from paperloom.operators import ingest as building

    monkeypatch.setattr(building, "BLOCK_CHUNKS", 20)
    often = "claim policy driver road night".split()
    rows = [(i, " ".join(often[: 1 + i % 5] * (1 + i % 3)) + (" hailstone" if i in (17, 430, 1111) else "") + f" w{i % 300}") for i in range(2000)]
    index = ingest(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "index"))
    asked = _ask(spark, "claim hailstone policy driver", "w7 claim night", "claim policy", "nothing known", "")
    key = lambda df: sorted((r["query_id"], r["rank"], r["chunk_id"], r["score"]) for r in df.collect())
    for k in (1, 3, 10):
        assert key(retrieval.retrieve_lexical(asked, index, k, direct=0)) == key(retrieval.retrieve_lexical(asked, index, k))
    read = []
    real = retrieval._needed_blocks
    monkeypatch.setattr(retrieval, "_needed_blocks", lambda *a: read.append(real(*a)) or read[-1])
    retrieval.retrieve_lexical(_ask(spark, "claim hailstone policy driver"), index, 3, direct=0)
    count = lambda df: df.agg(F.sum(F.size("entries"))).first()[0]
    whole = count(index.blocks.filter(F.col("term").isin("claim", "hailstone", "policy", "driver")))
    assert count(read[0]) < whole / 10


def test_model_distances_whatever_the_slices():
    texts = ["ab", "abb", "b", "", "ba", "a" * 9, "nan"] * 3
    model = lambda part: [[float("nan")] * 2 if t == "nan" else [float(t.count("a")), float(t.count("b"))] for t in part]
    whole = chunking.vector_distances(texts, model, 1000)
    plain = []
    for u, v in zip(model(texts), model(texts)[1:]):
        norms = math.hypot(*u) * math.hypot(*v)
        plain.append(1 - sum(a * b for a, b in zip(u, v)) / norms if norms > 0 else 1.0)
    assert np.allclose(whole, plain)
    for size in (1, 2, 5):
        assert np.allclose(chunking.vector_distances(texts, model, size), whole)
    assert len(chunking.vector_distances([], model)) == 0
    with pytest.raises(ValueError, match="for 3 texts"):
        chunking.vector_distances(texts[:3], lambda part: [[1.0]])


def make_topic_model():
    """Vectors by subject; a task that made two models would be seen in the first number."""
    return lambda part: [[float("cat" in t), float("tax" in t), 0.1] for t in part]


def test_chunks_by_model(spark):
    text = "A cat sat. The cat ran. One cat ate. A tax rose. The tax fell. My tax is due."
    rows = [(1, text, "x"), (2, None, "x"), (3, "", "x"), (4, "One. Two.", "x"), (5, text, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gaps_of string")
    cut = chunking.chunk_semantic(docs, buffer=0, percentile=80, make_model=make_topic_model)
    got = {}
    for r in cut.orderBy("doc_id", "segment", "part").collect():
        got.setdefault(r["doc_id"], []).append(r["text"])
    halves = ["A cat sat. The cat ran. One cat ate.", "A tax rose. The tax fell. My tax is due."]
    assert got == {1: halves, 4: ["One. Two."], 5: halves}
    assert "Exchange" not in cut._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_rows_of_one_id_are_one_hit(spark, metric, monkeypatch):
    """Ids with up to 50 rows each, against the best of all scores; blocks of questions and of rows as well."""
    rng = np.random.default_rng(11)
    rows = [(f"p{i}", rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(12) for _ in range(50 if i < 3 else 2)]
    asked = [(q, rng.integers(-3, 4, 4).astype(float).tolist()) for q in range(7)]
    index = spark.createDataFrame(rows, "chunk_id string, embedding array<double>").repartition(5)
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    every = search.top_k(index, queries, 10_000, metric).collect()
    best = {}
    sign = -1 if metric == "euclidean" else 1
    for r in every:
        key = r["query_id"], r["chunk_id"]
        best[key] = max(best.get(key, -np.inf), sign * r["score"])
    want = [(q, i + 1, p, sign * s + 0.0) for q in range(7) for i, (s, p) in enumerate(sorted(((s, p) for (q2, p), s in best.items() if q2 == q), key=lambda x: (-x[0], x[1]))[:4])]
    for bounds in ({}, {"max_queries": 3}):
        got = search.top_k(index, queries, 4, metric, distinct=True, **bounds).orderBy("query_id", "rank").collect()
        assert [tuple(r) for r in got] == want
    matrix = search.QueryMatrix(list(range(7)), np.array([v for _, v in asked]), None, metric)
    monkeypatch.setattr(search, "BLOCK_CELLS", 21)  # three rows a block
    task = search.Best(matrix, 4, None, distinct=True)
    task.add(pa.table({"chunk_id": [p for p, _ in rows], "embedding": [v for _, v in rows]}), "chunk_id")
    assert sorted(zip(task.q.tolist(), task.ids.tolist(), (sign * task.s + 0.0).tolist())) == sorted((q, p, s) for q, _, p, s in want)


def test_a_model_scores_in_batches(spark):
    """One model for all batches of a task; pairs with a null side are not handed over."""
    made = spark.range(1000).select(
        (F.col("id") % 4).alias("query_id"), F.when(F.col("id") != 8, "hail").alias("question"), F.col("id").cast("string").alias("chunk_id"),
        F.when(F.col("id") != 9, F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("text"),
    )

    def make_scorer():
        sizes = []

        def score(questions, texts):
            assert 0 < len(questions) == len(texts) <= 256 and None not in questions and None not in texts
            sizes.append(len(texts))
            return [float(len(t)) for t in texts]

        return score

    got = retrieval.rerank(made.coalesce(1), 300, make_scorer=make_scorer).collect()
    assert {r["chunk_id"]: r["score"] for r in got} == {str(i): 0.0 if i in (8, 9) else float(i) for i in range(1000)}
    with pytest.raises(Exception, match="1 scores for"):
        retrieval.rerank(made, 3, make_scorer=lambda: lambda q, t: [0.0]).collect()


def test_parts_are_bounded_and_files_grow(spark, tmp_path, monkeypatch):
    """However many documents, so many folders; the same hits from parts of several files."""
    assert ingesting.parts_for(0) == (8, 1) and ingesting.parts_for(10**6) == (20, 1)
    assert ingesting.parts_for(2 * 10**10) == (1024, 391)
    docs = spark.createDataFrame([(i, f"word{i} common hail{i % 7}") for i in range(60)], "doc_id long, text string")
    whole = ingest(docs, str(tmp_path / "whole"))
    for name, value in {"MIN_PARTS": 2, "MAX_PARTS": 3, "PART_ROWS": 5, "POSTING_FILE_ROWS": 10, "TERM_FILE_ROWS": 20, "BLOCK_CHUNKS": 4}.items():
        monkeypatch.setattr(ingesting, name, value)
    split = ingest(docs, str(tmp_path / "split"))
    for name in ("chunks", "blocks"):
        folders = list((tmp_path / "split" / name).glob("part=*"))
        assert len(folders) == 3 and sum(len(list(f.glob("*.parquet"))) for f in folders) > 3
    asked = _ask(spark, "hail3 common", "word12 hail5")
    for find in (retrieval.retrieve, retrieval.retrieve_lexical):
        hits = [sorted(map(tuple, retrieval.with_texts(find(asked, i, 5), i).collect())) for i in (whole, split)]
        assert hits[0] == hits[1] and len(hits[0]) == 10


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "dot"])
def test_readings_follow_from_cells_not_from_blocks(spark, metric):
    """Hundreds of blocks of questions are one reading, with the hits of a single block."""
    rng = np.random.default_rng(9)
    rows = spark.createDataFrame([(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(600)], "chunk_id long, embedding array<float>")
    asked = rows.withColumnRenamed("chunk_id", "query_id")
    hits = lambda **of: sorted(map(tuple, top_k(rows, asked, 4, metric, **of).collect()))
    whole = hits()
    spark.sparkContext.setJobGroup(f"grid-{metric}", "grid")
    try:
        assert hits(max_queries=2) == whole
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"grid-{metric}"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert jobs < 15


@pytest.mark.parametrize("held", [0, 3, 1000])
def test_vectors_beyond_the_term_bound_are_the_same(spark, monkeypatch, held):
    """Whether tasks hold none, some or all of the terms, and whatever the rows of an id."""
    rows = [(i // 2, "en" if i % 3 else None, f"common {'often ' * (i % 4)}w{i} w{i // 5}") for i in range(40)] + [(99, "en", None), (None, None, "often w3")]
    counts = embedding.term_counts(spark.createDataFrame(rows, "i long, lang string, text string").dropDuplicates(["i"]), ["i", "lang"])
    idf = embedding.counted_idf(counts, 22)
    key = lambda df: {(r["i"], r["lang"]): dict(zip(r["buckets"], r["weights"])) for r in df.collect()}
    whole = key(embedding.embed_counts(counts, ["i", "lang"], 1024, idf, 22))
    monkeypatch.setattr(embedding, "MAX_BROADCAST_TERMS", 2)
    monkeypatch.setattr(embedding, "KNOWN_TERMS", held)
    made = embedding.embed_counts(counts, ["i", "lang"], 1024, idf, 22)
    got = key(made)
    assert got.keys() == whole.keys() and len(got) == 21
    assert all(got[k].keys() == whole[k].keys() and all(math.isclose(got[k][b], w, rel_tol=1e-6) for b, w in whole[k].items()) for k in whole)


def test_block_lists_come_without_a_row_for_each_posting(spark, tmp_path):
    """Postings are gathered in the task that reads the counts, so that lists are shuffled."""
    rows = [(i, f"claim policy w{i}") for i in range(400)]
    index = ingest(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "index"))
    lists = ingesting.block_lists(index.counts, index.parts, index.n_blocks, index.mean_terms)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    often = lists.filter("term = 'claim'")
    assert often.count() == index.blocks.filter("term = 'claim'").count() < 100
    listed = {(r["term"], c, t, n) for r in lists.collect() for c, t, n in zip(r["chunk_id"], r["tf"], r["n"])}
    assert listed == {(t, f"{i}#0", 1, 3) for i in range(400) for t in ("claim", "policy", f"w{i}")}
    assert {(r["term"], r["chunk_id"], r["tf"], r["n"]) for r in index.postings.collect()} == listed


@pytest.mark.parametrize("direct", [0, 10**9])
def test_lexical_hits_from_the_terms_of_chunks(spark, tmp_path, monkeypatch, direct):
    """Many postings are not shuffled, whether blocks are left out or not; ids that repeat or are null are one hit as before."""
    often = "claim policy driver road night".split()
    rows = [(i // 2 if i < 40 else i, " ".join(often[: 1 + i % 5] * (1 + i % 3)) + f" w{i % 30}") for i in range(500)] + [(None, "claim w3"), (None, "policy w4")]
    index = ingest(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "index"))
    once = index.counts.groupBy("chunk_id").count().filter("count > 1")
    assert once.count() == 21
    asked = _ask(spark, "claim hailstone policy driver", "w7 claim night", "claim policy", "nothing known", "")
    listed = lambda: sorted((r["query_id"], r["rank"], r["score"]) for r in retrieval.retrieve_lexical(asked.filter("query_id <> 1"), index, 3, direct=direct).collect())
    ids = lambda: sorted(r["chunk_id"] for r in retrieval.retrieve_lexical(asked.filter("query_id = 1"), index, 3, direct=direct).collect())
    want, named = listed(), ids()
    monkeypatch.setattr(retrieval, "SCAN_POSTINGS", 0)
    monkeypatch.setattr(retrieval, "SCAN_SHARE", 0.0)
    plans, original = [], retrieval.top_k
    monkeypatch.setattr(retrieval, "top_k", lambda chunks, *a, **b: plans.append(chunks) or original(chunks, *a, **b))
    assert listed() == want and ids() == named
    assert "counts" in str(plans[0].inputFiles()) and "blocks" not in str(plans[0].inputFiles())


def test_an_index_is_built_with_one_shuffle_of_what_grows(spark, tmp_path, monkeypatch):
    """Posting lists and vectors of any number of terms are written by the tasks that read the counts, and nothing is sorted first."""
    plans = []
    from pyspark.sql.readwriter import DataFrameWriter

    original = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **b: plans.append((path, self._df, spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))) or original(self, path, *a, **b))
    monkeypatch.setattr(embedding, "MAX_BROADCAST_TERMS", 3)
    rows = [(i, f"often {'common ' * (i % 3)}w{i} v{i // 3}") for i in range(90)] + [(99, None), (100, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = ingest(docs, str(tmp_path / "index"))
    plan = {path.rsplit("/", 1)[1]: df._jdf.queryExecution().executedPlan().toString() for path, df, _ in plans}
    assert all("Exchange" not in plan[n] and "Sort" not in plan[n] for n in ("blocks", "vectors"))
    writers = {path.rsplit("/", 1)[1]: int(n) for path, _, n in plans}
    assert writers["blocks"] > index.term_parts == 8 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == str(writers["counts"])
    # the same vectors as by a table of all terms
    monkeypatch.setattr(embedding, "MAX_BROADCAST_TERMS", 10**6)
    keep = ["chunk_id", "doc_id"]
    whole = {r["chunk_id"]: dict(zip(r["buckets"], r["weights"])) for r in embedding.embed_counts(index.counts, keep, 1024, index.terms, index.n_chunks).collect()}
    got = {r["chunk_id"]: dict(zip(r["buckets"], r["weights"])) for r in index.vectors.collect()}
    assert got.keys() == whole.keys() and len(got) == 90
    assert all(got[k].keys() == whole[k].keys() and all(math.isclose(got[k][b], w, rel_tol=1e-6) for b, w in whole[k].items()) for k in whole)
    # beyond the bound terms are joined, to the same vectors
    monkeypatch.setattr(embedding, "MAX_HELD_TERMS", 2)
    monkeypatch.setattr(embedding, "KNOWN_TERMS", 4)
    joined = {r["chunk_id"]: dict(zip(r["buckets"], r["weights"])) for r in embedding.embed_counts(index.counts, keep, 1024, index.terms, index.n_chunks, own=True).collect()}
    assert joined.keys() == whole.keys() and all(math.isclose(joined[k][b], w, rel_tol=1e-6) for k in whole for b, w in whole[k].items())


@pytest.mark.parametrize("dim", [7, 1024])
def test_held_terms_have_the_buckets_of_the_table(spark, dim):
    import pyarrow as pa

    names = ["a", "naïve", "слово", "中文", "x" * 300]
    table = spark.createDataFrame([(t,) for t in names], "term string")
    want = {r["term"]: r["b"] for r in table.select("term", embedding.term_bucket(F.col("term"), dim).alias("b")).collect()}
    keys, buckets = embedding._digests(pa.array(names), dim)
    assert dict(zip(names, buckets.tolist())) == want and len(set(keys.tolist())) == len(names)
    held = embedding.HeldTerms(pa.table({"key": pa.array(keys[:2].astype("int64")), "weight": [2.0, 3.0]}), dim, 5.0)
    assert held.weights(keys).tolist() == [2.0, 3.0, 5.0, 5.0, 5.0]


@pytest.mark.parametrize("small", [0, 10**6])
def test_lists_of_few_postings_a_file_are_brought_together(spark, tmp_path, monkeypatch, small):
    """Many small files are not made; more folders of chunks than of terms are asked as well."""
    monkeypatch.setattr(ingesting, "SMALL_FILES", small)
    monkeypatch.setattr(ingesting, "TERM_PARTS", 3)
    index = ingest(spark.createDataFrame([(i, f"common w{i} hail{i % 7}") for i in range(70)], "doc_id long, text string"), str(tmp_path / "i"))
    assert (index.parts, index.term_parts) == (8, 3) and {r["part"] for r in index.blocks.select("part").distinct().collect()} == {0, 1, 2}
    assert {(r["term"], r["chunk_id"]) for r in index.postings.collect()} == {(t, f"{i}#0") for i in range(70) for t in ("common", f"w{i}", f"hail{i % 7}")}
    hits = retrieval.retrieve_lexical(_ask(spark, "w12 hail5", "hail0"), index, 11).collect()
    assert {h["chunk_id"] for h in hits if h["query_id"] == 0} == {f"{i}#0" for i in range(70) if i % 7 == 5 or i == 12}
    assert len([h for h in hits if h["query_id"] == 1]) == 10
