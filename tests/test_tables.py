import pytest
from pyspark.sql import functions as F

from paperloom.operators import evaluation, joins, lookups
from paperloom.operators.feedback import feedback_rates, join_feedback


def _registry(spark):
    rows = [(0, " kb ", "a", "9"), (1, "kb", "b", "10"), (2, "other", "c", "2"), (3, "kb", "d", "1")]
    return spark.createDataFrame(rows, "ordinal int, name string, id string, version string")


def test_lookups(spark):
    registry = _registry(spark)
    assert lookups.lookup_first(registry, "kb", "name", "ordinal").first()["id"] == "b"
    assert tuple(lookups.lookup_policy(registry, "kb").first()) == ("a", "9")
    assert lookups.lookup_policy(registry, "none").count() == 0
    names = spark.createDataFrame([("kb",), (" other\t",), ("none",)], "name string")
    got = {r["name"]: (r["id"], r["not_found"]) for r in lookups.lookup_join(names, registry).collect()}
    assert got == {"kb": ("a", False), " other\t": ("c", False), "none": (None, True)}


def test_latest_version_is_numeric(spark):
    got = {r["name"]: r["id"] for r in lookups.latest_version(_registry(spark)).collect()}
    assert got == {" kb ": "a", "kb": "b", "other": "c"}


def test_membership_and_registration(spark):
    wanted = spark.createDataFrame([("kb",), ("new",), ("new",)], "name string")
    there, absent = lookups.exists_in(wanted, _registry(spark), "name")
    assert there.count() == 1 and absent.count() == 2
    assert [r["name"] for r in lookups.ensure(wanted, _registry(spark)).collect()] == ["new"]


def test_drop_empty(spark):
    rows = spark.createDataFrame([(1, {"a": 1}), (2, {}), (3, None)], "i int, e map<string,int>")
    assert [r["i"] for r in lookups.drop_empty(rows, "e").collect()] == [1]


def test_join_unique_with_a_hot_key(spark):
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 5 != 0, F.col("id"))
    left = spark.range(6000).select(key.alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 6000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("left", "inner"):
        want = sorted(map(str, left.join(right, "k", how).collect()))
        assert sorted(map(str, joins.join_unique(left, right, ["k"], how, max_rows=5).collect())) == want
        assert sorted(map(str, joins.join_unique(left, right, ["k"], how).collect())) == want


def test_feedback(spark):
    answers = spark.createDataFrame([("q", "a"), ("q", "b")], "question string, answer string")
    clicks = spark.createDataFrame([("q", "a", "up"), ("q", "a", "up"), ("q", "a", "down"), ("q", "a", "meh"), ("q", "a", None)], "question string, answer string, rating string")
    got = {r["answer"]: (r["n_up"], r["n_down"], r["n_other"]) for r in join_feedback(answers, clicks).collect()}
    assert got == {"a": (2, 1, 2), "b": (0, 0, 0)}
    assert feedback_rates(clicks).first()["helpful_share"] == 0.666667
    assert feedback_rates(clicks.filter("rating = 'meh'")).first()["helpful_share"] is None


def test_concat_ordered_ignores_block_size(spark):
    rows = spark.createDataFrame([(k, i, f"{k}{i}") for k in "ab" for i in reversed(range(25))], "k string, i int, text string")
    want = {k: "|".join(f"{k}{i}" for i in range(25)) for k in "ab"}
    for block in (1, 7, 1000):
        got = evaluation.concat_ordered(rows, "k", "i", sep="|", block=block)
        assert {r["k"]: r["text"] for r in got.collect()} == want


def test_model_tables(spark):
    rows = [("m2", 0, 1.0), ("m1", 1, 2.0), ("m2", 0, 3.0)]
    runs = spark.createDataFrame(rows, "model_id string, ordinal int, time_seconds double")
    got = [(r["model_id"], r["n_runs"], r["avg_seconds"]) for r in evaluation.model_table(runs).collect()]
    assert got == [("m2", 2, 2.0), ("m1", 1, 2.0)]
    last = evaluation.last_per_model(runs.withColumn("at", F.col("time_seconds")), "model_id", "at", ["time_seconds"])
    assert {r["model_id"]: r["time_seconds"] for r in last.collect()} == {"m2": 3.0, "m1": 2.0}


def test_no_join_is_a_cross_join(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = evaluation.cross_models(docs, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Exchange" not in plan


def test_interval_draws_are_poisson_of_mean_one(spark):
    cuts = evaluation._poisson_cuts()
    assert cuts == [24109, 48219, 60273, 64292, 65296, 65497, 65531, 65535]
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 10).cast("double").alias("v"))
    got = evaluation.mean_interval(rows, "v", "doc_id").first()
    assert got["n"] == 4000 and got["mean"] == 4.5 and got["share_not_above_zero"] == 0
    # the standard error of 4,000 values with a variance of 8.25, times 1.96 on both sides
    assert got["low"] < 4.5 < got["high"] and abs((got["high"] - got["low"]) / (2 * 1.96 * (8.25 / 4000) ** 0.5) - 1) < 0.2
    assert got == evaluation.mean_interval(rows.repartition(7), "v", "doc_id").first()


def test_interval_of_changes(spark):
    rows = [(i, side, 0.5 + (0.2 if side else 0.0)) for i in range(40) for side in (False, True)] + [(99, True, 5.0)]
    evals = spark.createDataFrame(rows, "doc_id long, policy boolean, accuracy double")
    got = evaluation.ab_interval(evals, replicates=16).first()
    # the key with one side only has no change
    assert (got["n"], got["mean"], got["low"], got["high"], got["share_not_above_zero"]) == (40, 0.2, 0.2, 0.2, 0.0)


def test_interval_of_nulls_and_groups(spark):
    rows = spark.createDataFrame([("a", 1, 2.0), ("a", None, 2.0), ("b", 3, None), (None, 4, 7.0)], "g string, k int, v double")
    got = {r["g"]: (r["n"], r["mean"]) for r in evaluation.mean_interval(rows, "v", "k", "g", replicates=8).collect()}
    assert got == {"a": (2, 2.0), None: (1, 7.0)}
    with pytest.raises(ValueError):
        evaluation.mean_interval(rows, "v", "k", replicates=12)


def test_sketches_of_runs_add_up(spark):
    runs = spark.range(30_000).select(
        (F.col("id") % 3).alias("run"),
        F.when(F.col("id") % 5 == 0, "slow").otherwise("fast").alias("model_id"),
        (F.col("id") / 1000).alias("time_seconds"),
        (F.col("id") % 7 != 0).alias("ok"),
    )
    failed = spark.createDataFrame([(3, "dead", 1.0, False), (3, "slow", 29.5, None)], runs.schema)
    kept = evaluation.time_sketches(runs, "run").unionByName(evaluation.time_sketches(failed, "run"))
    got = {r["model_id"]: r for r in evaluation.model_table_of(kept).collect()}
    exact = {r["model_id"]: r for r in evaluation.model_table(runs.unionByName(failed).withColumn("ordinal", F.lit(0))).collect()}
    for model in ("slow", "fast"):
        for same in ("n_runs", "n_failed", "avg_seconds", "min_seconds", "max_seconds"):
            assert got[model][same] == exact[model][same]
        for near in ("median_seconds", "p95_seconds"):
            assert abs(got[model][near] - exact[model][near]) <= 30 * 2 * evaluation.SKETCH_RANK_ERROR
    assert (got["dead"]["n_runs"], got["dead"]["n_failed"], got["dead"]["median_seconds"]) == (1, 1, None)
    assert {r["model_id"] for r in evaluation.model_table_of(kept, "run", "model_id").filter("run = 3").collect()} == {"dead", "slow"}
