from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paperloom.llm.mixing import leaf_budgets, mix_sources
from paperloom.llm.queries import mix_levels


def fill(children, total):
    """Brute force of one level, in fractions: capacities and weights to parts."""
    parts, rest, left = {}, dict(children), total
    while rest:
        weight = sum(w for _, w in rest.values())
        full = {k: c for k, (c, w) in rest.items() if c <= left * w / weight}
        if not full:
            return {**parts, **{k: left * w / weight for k, (_, w) in rest.items()}}
        parts |= full
        left -= sum(full.values())
        rest = {k: v for k, v in rest.items() if k not in full}
    return parts


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = [("a", "x", 10), ("a", "y", 1000), ("b", "x", 40), ("b", "y", 60)]
    supply = spark.createDataFrame(leaves, "l0 string, l1 string, supply bigint")
    got = {(r["l0"], r["l1"]): r["budget"] for r in leaf_budgets(supply, ["l0", "l1"], {}, 160, 1).collect()}
    # half each: a's x is short and y takes it over, b stays within its half
    assert got == {("a", "x"): 10, ("a", "y"): 70, ("b", "x"): 40, ("b", "y"): 40}
    got = {(r["l0"], r["l1"]): r["budget"] for r in leaf_budgets(supply, ["l0", "l1"], {("b",): 3}, 160, 1).collect()}
    # b as a whole holds 100 of its 120: only then a takes over
    assert got == {("a", "x"): 10, ("a", "y"): 50, ("b", "x"): 40, ("b", "y"): 60}


def test_budgets_agree_with_brute_force(spark):
    leaves = [(f"d{i % 3}", f"s{i}", (i * 37) % 101 + 1) for i in range(30)]
    weights = {("d0",): 5, ("d1",): 2, **{(f"d{i % 3}", f"s{i}"): i % 4 + 1 for i in range(30)}}
    supply = spark.createDataFrame(leaves, "l0 string, l1 string, supply bigint")
    got = {(r["l0"], r["l1"]): r["budget"] for r in leaf_budgets(supply, ["l0", "l1"], weights, 2500, 2).collect()}
    caps = {(d, s): 2 * n for d, s, n in leaves}
    domains = fill({d: (sum(c for k, c in caps.items() if k[0] == d), weights.get((d,), 1)) for d in ("d0", "d1", "d2")}, 2500)
    assert sum(got.values()) == pytest.approx(2500, abs=1)
    for d, part in domains.items():
        want = fill({k: (c, weights[k]) for k, c in caps.items() if k[0] == d}, part)
        for k, v in want.items():
            assert got[k] == pytest.approx(v, abs=2), k


def test_epochs_and_prefix(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 5 + 1).cast("int")).alias("text"), F.lit("s").alias("source"))
    rows = mix_sources(docs, [F.col("source")], {}, 400, seed=3).collect()
    assert sum(r["tokens_taken"] for r in rows) == 400  # 150 tokens: two epochs and 100 of the third
    by_epoch = defaultdict(list)
    for r in rows:
        by_epoch[r["epoch"]].append(r)
    assert len(by_epoch[0]) == len(by_epoch[1]) == 50
    assert sum(r["tokens_taken"] for r in by_epoch[2]) == 100
    assert sum(r["tokens_taken"] < r["tokens"] for r in by_epoch[2]) <= 1
    other = mix_sources(docs, [F.col("source")], {}, 400, seed=4).filter("epoch = 2").select("doc_id").collect()
    assert {r["doc_id"] for r in other} != {r["doc_id"] for r in by_epoch[2]}
    all_there_is = mix_sources(docs, [F.col("source")], {}, 10_000, max_epochs=3).agg(F.sum("tokens_taken")).first()[0]
    assert all_there_is == 450


def test_odd_rows(odd, none):
    df = odd.withColumn("EPOCH", F.lit("x")).withColumn("_tokens", F.lit(0)).withColumn("_level0", F.lit(0)).withColumn("supply", F.lit(1))
    out = mix_sources(df, mix_levels(), {}, 1.0)
    rows = out.collect()
    assert out.columns == [*odd.columns, "_tokens", "_level0", "supply", "epoch", "tokens", "tokens_taken"]
    total = out.agg(F.sum("tokens_taken")).first()[0]
    assert total == odd.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0]
    assert all(0 <= r["tokens_taken"] <= r["tokens"] for r in rows)
    assert mix_sources(none, mix_levels(), {}, 1.0).count() == 0
    with pytest.raises(ValueError):
        mix_sources(odd, mix_levels(), {("web",): 0}, 1.0)


def test_rows_of_equal_key_are_all_read(spark):
    docs = spark.createDataFrame([(1, "a b c", "s")] * 9, "doc_id bigint, text string, source string")
    taken = Counter(r["tokens_taken"] for r in mix_sources(docs, [F.col("source")], {}, 20).collect())
    assert taken == {3: 6, 2: 1}


def test_plan_has_no_python(odd):
    plan = mix_sources(odd, mix_levels(), {}, 0.5)._jdf.queryExecution().toString()
    assert "ArrowEval" not in plan and "MapInArrow" not in plan and "BatchEvalPython" not in plan
