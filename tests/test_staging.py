from pathlib import Path

from pyspark.sql import functions as F

from paperloom import staging
from paperloom.operators import joins
from paperloom.operators.joins import join_unique


def test_stage_tables_are_removed(spark, monkeypatch):
    monkeypatch.setattr(staging, "_staged", [])
    table = staging.stage(spark.range(3), "t")
    path = Path(staging._staged[0])
    assert table.count() == 3 and path.exists()
    own = staging.stage_path(spark, "mine")
    spark.range(1).write.parquet(own)
    assert staging.remove_stages(spark) == 1 and not path.exists() and Path(own).exists()
    scratch = staging.scratch_path(spark, "work")
    spark.range(1).write.parquet(f"{scratch}/block=0")
    assert staging.remove_stages(spark) == 1 and not Path(scratch).exists()


def test_bounds_are_in_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.lit(1.0)).alias("v"), F.struct("id").alias("s"))
    assert staging.fits(df, 100) and not staging.fits(df, 99)
    assert not staging.fits(df, 100, 100_000) and staging.fits(df, 100, 200_000)
    assert staging.fits(df.filter("1 = 0"), 0, 0)


def test_long_rows_are_not_broadcast(spark, monkeypatch):
    left = spark.range(50).select((F.col("id") % 5).alias("k"))
    right = spark.range(5).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("t"))
    monkeypatch.setattr(joins, "fits", lambda df, rows: staging.fits(df, rows, 1000))
    out = join_unique(left, right, ["k"])
    assert out.count() == 50 and out.filter("length(t) = 1000").count() == 50
