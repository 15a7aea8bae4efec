"""Lookups by name, membership, registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.functions.text import strip
from paperloom.operators.joins import join_unique
from paperloom.staging import stage


def lookup_first(df: DataFrame, name: str, name_col: str, order_col: str) -> DataFrame:
    """the first row in listing order with this name; none if not found."""
    return df.filter(F.col(name_col) == name).orderBy(order_col).limit(1)


def lookup_policy(df: DataFrame, name: str, name_col: str = "name", order_col: str = "ordinal") -> DataFrame:
    """``(id, version)`` of the first entry whose trimmed name matches."""
    return df.filter(strip(name_col) == name).orderBy(order_col).limit(1).select("id", "version")


def exists_in(df: DataFrame, names: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """``(already there, to create)``; however often a name is listed or asked."""
    listed = names.select(on).distinct().withColumn("_listed", F.lit(True))
    marked = join_unique(df, listed, [on])
    there = F.col("_listed").isNotNull()
    return marked.filter(there).select(*df.columns), marked.filter(~there).select(*df.columns)


def drop_empty(df: DataFrame, entry: str) -> DataFrame:
    """drop rows whose array or map entry is empty or missing."""
    return df.filter(F.size(entry) > 0)


def filter_metadata(df: DataFrame, key: str, value: str) -> DataFrame:
    """metadata equality; apply before scoring so the scan is pruned."""
    return df.filter(F.col(key) == value)


def keep_first(registry: DataFrame, name: Column, order_col: str, columns: list[str]) -> DataFrame:
    """One row per name, the first in listing order; combined before the shuffle."""
    entry = F.struct(*columns)
    return registry.groupBy(name.alias("_name")).agg(F.min_by(entry, order_col).alias("_entry")).select("_name", "_entry.*")


def lookup_join(names: DataFrame, registry: DataFrame, name: str = "name", order_col: str = "ordinal") -> DataFrame:
    """Id and version for many names, null with ``not_found`` where absent."""
    first = keep_first(registry, strip(name), order_col, ["id", "version"]).withColumn("_found", F.lit(True))
    joined = join_unique(names.withColumn("_name", strip(name)), first, ["_name"])
    return joined.withColumn("not_found", F.col("_found").isNull()).drop("_name", "_found")


def ensure(df: DataFrame, registry: DataFrame, name: str = "name") -> DataFrame:
    """The names to register, once each; a null is no name."""
    return df.select(name).filter(F.col(name).isNotNull()).distinct().join(registry.select(name), name, "left_anti")


def register(df: DataFrame, path: str, name: str = "name", order_col: str = "ordinal") -> DataFrame:
    """Append the missing names to the registry at ``path``; returns what was appended.

    New names are numbered on from the last, in order of names; a second run
    with the same names appends nothing.
    """
    spark = df.sparkSession
    registry = spark.read.parquet(path)
    fresh = stage(ensure(df, registry, name), "fresh")
    last = registry.agg(F.coalesce(F.max(order_col), F.lit(-1)).alias("m")).first()["m"]
    # counted in ranges of names, so that numbering needs no single sorted task
    ranged = stage(fresh.repartitionByRange(name).sortWithinPartitions(name).select(name, F.spark_partition_id().alias("_part")), "ranged")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = F.broadcast(sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(name))
    numbered = ranged.withColumn("_place", place).join(bases, "_part")
    kind = registry.schema[order_col].dataType
    added = stage(numbered.select(name, (F.lit(last) + F.col("_base") + F.col("_place")).cast(kind).alias(order_col)), "added")
    added.write.mode("append").parquet(path)
    return added


def latest_version(versions: DataFrame, name: str = "name") -> DataFrame:
    """V2: the highest version per name, compared as a number."""
    number = F.col("version").cast("long")
    return (
        versions.groupBy(name)
        .agg(F.max_by(F.struct("id", "version"), F.struct(number, F.col("id"))).alias("_latest"))
        .select(name, "_latest.*")
    )
