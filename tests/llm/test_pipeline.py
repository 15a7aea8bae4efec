"""The pipeline against a brute-force version, stage by stage, and the registered queries with SQL."""

import sys
from pathlib import Path

import pytest
from compare import compare, oracle

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from paperloom.llm.language import held_out, learn_profiles  # noqa: E402
from paperloom.llm.queries import ORACLES, QUERIES, table  # noqa: E402
from paperloom.llm.secrets import Scanner, _masked  # noqa: E402
from paperloom.llm.simhash import fingerprint  # noqa: E402

SF = "/root/testdata/sf0.001"
CON = oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, CON, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_contract_of_the_sharding_query(spark):
    from collections import Counter
    from zlib import crc32

    rows = QUERIES["op1_sharding"](spark, SF).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {k: (len(t.encode()) + 1, crc32(t.encode())) for k, t in docs.items()}
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)


def test_stages_agree_with_brute_force(spark):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r for r in docs.collect()}

    told = stages["language"](spark, docs, SF)
    assert told.columns == docs.columns
    profiles = learn_profiles(docs.filter(~held_out()))
    kept = {k for k, r in rows.items() if profiles.predict(r["text"])[0] != "und"}
    assert {r["doc_id"] for r in told.collect()} == kept

    single = stages["near_copies"](spark, told, SF)
    prints = sorted((k, fingerprint(rows[k]["text"])) for k in kept)
    first = {}
    for k, f in prints:  # components by repeated passes
        first[k] = k
    changed = True
    while changed:
        changed = False
        for a, f in prints:
            for b, g in prints:
                if first[a] < first[b] and ((f ^ g) & (2**64 - 1)).bit_count() <= 4:
                    first[b], changed = first[a], True
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(k for k in kept if first[k] == k)

    clean = stages["secrets"](spark, single, SF)
    scanner = Scanner()
    want = {k: _masked(rows[k]["text"], scanner, "[SECRET]") for k in kept if first[k] == k}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in clean.collect()} == {k: (t, len(t)) for k, t in want.items()}
    assert any(t != rows[k]["text"] for k, t in want.items())

    mixed = stages["weights"](spark, clean, SF)
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= set(want)

    last = stages["pieces"](spark, mixed, SF)
    assert {"doc_id", "ids", "starts", "ends"} <= set(last.columns) and last.count() == mixed.count()


def test_odd_documents_pass(spark, odd, none):
    for docs in (odd, none):
        for _, step in corpus_pipeline.STAGES:
            docs = step(spark, docs, SF)
        docs.collect()


def test_stages_give_back_columns_of_clashing_names(spark, odd):
    """Extra columns come out of every stage but the last as they went in, whatever they are called."""
    from pyspark.sql import functions as F

    names = ["score", "lang_pred", "_seen", "tokens", "epoch", "tokens_taken", "secrets", "fingerprint", "_row", "_value"]
    docs = odd.select("*", *[F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in names])
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[n] == f"{n}:{'-' if r['doc_id'] is None else r['doc_id']}" for r in rows for n in names), name
        assert step(spark, docs.filter("1 = 0"), SF).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {"ids", "starts", "ends", *names} <= set(last.columns) and last.count() == odd.count()
