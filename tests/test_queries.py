"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, oracle

from paperloom.checks import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        df.collect()


def test_entry_returns_ranked_hits(spark):
    import __spark_entry__

    hits = __spark_entry__.entry(spark)
    assert hits.columns == ["query_id", "rank", "chunk_id", "score"]
    assert hits.count() > 0


def test_every_inventory_group_is_registered():
    groups = {"s": 9, "t": 5, "p": 12, "x": 8, "f": 5, "g": 8, "c": 3, "e": 8, "r": 8, "k": 10, "m": 10, "w": 5}
    ids = {name.split("_")[0] for name in QUERIES}
    for letter, n in groups.items():
        assert {f"{letter}{i}" for i in range(1, n + 1)} <= ids
    assert {f"j{i}" for i in range(1, 9)} <= ids
    assert {"v2", "v3", "v4", "v5"} <= ids  # V1 is the chunk ordinal of C1
