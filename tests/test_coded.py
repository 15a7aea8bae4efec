"""Product-quantised codes against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import coded
from paperloom.operators.coded import Codebook, build_coded, fit_centers, open_coded, recall
from paperloom.operators.search import top_k


def _table(spark, rows, ids=None):
    return spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in zip(ids if ids is not None else range(len(rows)), rows)], "id long, embedding array<float>")


@pytest.fixture(scope="module")
def gathered():
    """6,000 vectors around 60 places, and questions beside some of them."""
    rng = np.random.default_rng(3)
    places = rng.normal(size=(60, 32))
    rows = places[np.arange(6000) % 60] + 0.35 * rng.normal(size=(6000, 32))
    return rows, rows[::97] + 0.1 * rng.normal(size=(len(rows[::97]), 32))


def test_most_exact_hits_are_found_in_few_lists(spark, gathered, tmp_path):
    rows, asked = gathered
    index = build_coded(_table(spark, rows), str(tmp_path / "coded"), "id")
    questions = _table(spark, asked).withColumnRenamed("id", "query_id")
    exact = top_k(_table(spark, rows), questions, 5, id_col="id")
    measured = recall(index.search(questions, 5, n_probe=8), exact, id_col="id").agg(F.sum("n_found"), F.sum("n_exact")).first()
    assert len(index.book.centers) == 77 and measured[1] == 5 * len(asked) and measured[0] >= 0.95 * measured[1]
    # a tenth of the lists is a tenth of the rows, about
    read = index.table.filter(F.col("list").isin(list(range(8)))).count()
    assert read < 2000
    # all lists and all rows scored again: the exact hits, in blocks of questions too
    key = lambda df: sorted(map(tuple, df.select("query_id", "rank", "id", "score").collect()))
    whole = index.search(questions, 5, n_probe=77, rescored=1200)
    assert key(whole) == key(exact)
    assert key(open_coded(spark, index.path).search(questions, 5, n_probe=77, rescored=1200, max_queries=20)) == key(exact)


def test_codes_are_those_of_the_nearest_entries(gathered):
    rows, _ = gathered
    book = Codebook.fit(rows[:1500], 20)
    lists, codes = book.code(rows[1500:1600])
    for row, at, own in zip(rows[1500:1600], lists, codes):
        assert at == ((book.centers - row) ** 2).sum(axis=1).argmin()
        rest = (row - book.centers[at]).reshape(8, 4)
        assert own.tolist() == [((book.entries[p] - rest[p]) ** 2).sum(axis=1).argmin() for p in range(8)]
    tables = book.tables(rows[:3])
    back = book.centers[lists] + np.concatenate([book.entries[p][codes[:, p]] for p in range(8)], axis=1)
    summed = rows[:3] @ book.centers[lists].T + sum(tables[p][codes[:, p]] for p in range(8)).T
    assert np.allclose(summed, rows[:3] @ back.T)
    assert np.abs(back - rows[1500:1600]).mean() < np.abs(book.centers[lists] - rows[1500:1600]).mean()


def test_centers_of_few_rows_are_the_rows():
    assert fit_centers(np.array([[1.0], [2.0], [1.0]]), 5).tolist() == [[1.0], [2.0]]
    assert sorted(fit_centers(np.array([[0.0]] * 50 + [[9.0]] * 50 + [[0.5]]), 2).ravel().round(1).tolist()) in ([0.0, 9.0], [0.5, 4.5])


def test_the_sample_is_bounded_and_every_row_is_coded(spark, gathered, tmp_path, monkeypatch):
    rows, _ = gathered
    seen = []
    real = Codebook.fit.__func__
    monkeypatch.setattr(coded.Codebook, "fit", classmethod(lambda cls, sample, *a: seen.append(len(sample)) or real(cls, sample, *a)))
    index = build_coded(_table(spark, rows), str(tmp_path / "coded"), "id", sample=500)
    assert 400 <= seen[0] <= 500 and index.table.count() == 6000


def test_odd_vectors(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [0.0, 2.0, 0.0]), (3, None), (4, []), (5, [1.0, None, 0.0]), (6, [float("nan"), 1.0, 1.0]), (7, [0.0, 0.0, 0.0]), (8, [1.0])],
        "id long, embedding array<float>",
    )
    index = build_coded(rows.withColumn("list", F.lit("mine")), str(tmp_path / "a"), "id")
    asked = spark.createDataFrame([(1, [2.0, 0.0, 0.0]), (2, [1.0]), (3, None), (4, [0.0, 0.0, 0.0])], "query_id long, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in index.search(asked, 3, n_probe=9).collect())
    assert got[:3] == [(1, 1, 1, 1.0), (1, 2, 1, 1.0), (1, 3, 2, 0.0)] and {g[0] for g in got} == {1, 4}
    empty = build_coded(rows.filter("id > 99"), str(tmp_path / "b"), "id")
    assert empty.search(asked, 3).count() == 0 and index.search(asked.filter("1 = 0"), 3).count() == 0


def test_one_reading_serves_many_questions(spark, gathered, tmp_path):
    """No candidate is a row: a search writes its hits only, and a core has a file of the index."""
    rows, _ = gathered
    index = build_coded(_table(spark, rows), str(tmp_path / "coded"), "id")
    assert index.table.select(F.input_file_name()).distinct().count() == min(spark.sparkContext.defaultParallelism, 3)
    questions = _table(spark, rows[:900]).withColumnRenamed("id", "query_id")
    spark.sparkContext.setJobGroup("coded", "coded")
    try:
        found = index.search(questions, 3, n_probe=8, max_queries=30).collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("coded"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert jobs < 15 and {r["id"] for r in found if r["rank"] == 1} == set(range(900))


def test_best_of_held_rows():
    """Few candidates and many, some lists or all: the k best of the best codes, equal scores by id."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    rows = rng.normal(size=(400, 8))
    rows[200:203] = rows[200]
    rows /= np.sqrt((rows * rows).sum(axis=1))[:, None]
    book = Codebook.fit(rows, 16)
    lists, codes = book.code(rows)
    by_list = np.argsort(lists, kind="stable")
    ids = [f"{900 - i:04d}" for i in range(400)]
    columns = [pa.array([ids[i] for i in by_list]), pa.array(lists[by_list].astype(np.int32)), pa.array([codes[i].tobytes() for i in by_list]), pa.array(np.ones(400)), pa.array(rows[by_list].tolist())]
    held = coded._Held(pa.table(columns, names=["id", "list", "codes", "norm", "embedding"]), "id", book)
    approximate, exact = rows @ book.decode(lists, codes)[by_list].T, np.round(rows @ rows[by_list].T, 6) + 0.0
    some = coded._visits(rows, book.centers, 4)
    assert some.sum(axis=1).tolist() == [4] * 400
    for visits in (None, some):
        seen = np.ones((400, 400), bool) if visits is None else visits[:, lists[by_list]]
        for wanted in (12, 100, 400):
            q, found, score = held.best(rows, visits, wanted, 3)
            for at in range(0, 400, 7):
                best = [r for r in np.argsort(-np.where(seen[at], approximate[at], -np.inf), kind="stable")[:wanted] if seen[at, r]]
                best.sort(key=lambda r: (-exact[at, r], ids[by_list[r]]))
                assert (found[q == at].tolist(), score[q == at].tolist()) == (best[:3], exact[at, best[:3]].tolist())


def test_candidates_of_all_rows_take_few_readings(spark, gathered, tmp_path):
    """However many candidates a question has, the index is not read once for a few questions."""
    rows, _ = gathered
    index = build_coded(_table(spark, rows), str(tmp_path / "coded"), "id")
    questions = _table(spark, rows[:900]).withColumnRenamed("id", "query_id")
    spark.sparkContext.setJobGroup("candidates", "candidates")
    try:
        found = index.search(questions, 3, n_probe=77, rescored=20_000).collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("candidates"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert jobs < 12 and {r["id"] for r in found if r["rank"] == 1} == set(range(900))
