"""Run registered queries and their SQL side by side.

    python tests/compare.py [--sf DIR] [name prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    return v


def _rows(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = [tuple(_value(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(made, key=repr)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want_names, want = _rows(rel.columns, rel.fetchall())
    if names != want_names:
        return f"columns {names} / {want_names}"
    if len(got) != len(want):
        missing, extra = set(map(repr, want)) - set(map(repr, got)), set(map(repr, got)) - set(map(repr, want))
        return f"rows {len(got)} / {len(want)}; extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"first difference {a} / {b}"
    return None


def main(args: list[str]) -> int:
    from paperloom.checks import ORACLES, QUERIES

    sf = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf, args = args[1], args[2:]
    spark, con, bad = session(), oracle(sf), 0
    for name, query in QUERIES.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            df = query(spark, sf)
            if name in ORACLES:
                fault = compare(df, con, ORACLES[name])
                note = "ok" if fault is None else f"DIFFERS {fault}"
            else:
                note = f"rows {len(df.collect())}"
                fault = None
        except Exception as e:  # report and go on
            fault = note = f"FAILED {type(e).__name__} {str(e)[:600]}"
        bad += fault is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
