"""Registry of queries over the given tables, each beside its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.prompts import render
from paperloom.operators.ingest import Index, ingest
from paperloom.shipping import ship_package
from paperloom.staging import stage_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Split a scan that has fewer partitions than the cluster has cores.

    A table of many files has enough of them and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_files(df: DataFrame, key: str, path: str, together: int = 1) -> None:
    """Append each row's ``value`` and a newline as a text file, in a folder named by its key.

    Folders are as many as rows; with ``together`` so many files lie in one folder at
    most and each is itself named by its key, so that fewer folders are listed. Rows of one key are lines of one file; null
    texts are empty lines. A task writes its files in place, under names that a
    repeated task writes again, so no driver moves them one after the other.
    """
    spark = df.sparkSession
    folder = qualified(spark, path)
    name = f"part-{uuid.uuid4().hex}.txt"
    keyed = df.select(F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("key"), F.coalesce("value", F.lit("")).alias("value"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = fs.FileSystem.from_uri(folder)
        rows = ((k, v) for b in batches for k, v in zip(b.column("key").to_pylist(), b.column("value").to_pylist()))
        for number, (at, lines) in enumerate(groupby(rows, lambda row: row[0])):
            place, file = f"{root}/{key}={at}", name
            if together > 1:
                place, file = f"{root}/{name[5:-4]}-{TaskContext.get().partitionId()}-{number // together}", f"{key}={at}-{name}"
            if number % together == 0:
                disk.create_dir(place, recursive=True)
            with disk.open_output_stream(f"{place}/{file}") as out:
                for _, line in lines:
                    out.write(line.encode() + b"\n")
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["n"])

    tasks = 4 * spark.sparkContext.defaultParallelism
    keyed.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(write, "n bigint").write.format("noop").mode("overwrite").save()


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a folder, as pyarrow names its file system."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString()
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri.removeprefix("file:")
    return uri.replace("s3a://", "s3://", 1)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *columns))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


_indexes: dict[tuple[str, str], Index] = {}


def document_index(spark: SparkSession, sf_dir: str) -> Index:
    """The index over ``documents``; built once per session, then reused."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _indexes:
        _indexes[key] = ingest(documents(spark, sf_dir, "lang"), stage_path(spark, "index"), metadata=("lang",))
    return _indexes[key]


CLAIM_FORM = (
    "Claimant Name: {name}\nPatient Name: {patient}\nPhone Number: +1 614-555-0{tail}\nPolicy Number: QX-{key}\n"
    "Incident Date: {date}\nClaim Amount: ${amount}\nSigned By: {name}\nIncident Description: {what} at lot {key}.\n\n"
    "Coverage on file:\n- Collision: Deductible: ${deductible}\n"
    "- Bodily Injury: ${person} per person / ${accident} per accident\n- Roadside Help: Included\n"
)


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim forms rendered from orders and their customers: ``(doc_id, text)``."""
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    form = render(
        CLAIM_FORM,
        name=F.col("c_name"),
        patient=F.when(key % 2 == 0, F.col("c_name")).otherwise(F.concat(F.lit("Patient "), F.col("o_custkey").cast("string"))),
        tail=F.lpad((key % 1000).cast("string"), 3, "0"),
        key=key,
        date=F.when(key % 3 == 0, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "MMMM d, yyyy")),
        amount=F.format_number("o_totalprice", 2),
        what=F.concat(F.col("c_mktsegment"), F.lit(" collision")),
        deductible=F.format_number(250 * (1 + key % 5), 0),
        person=F.format_number(25000 * (1 + key % 7), 0),
        accident=F.format_number(50000 * (1 + key % 7), 0),
    )
    return orders.join(customers, "o_custkey").select(key.alias("doc_id"), form.alias("text"))


CLAIMS_SQL = r"""claims AS (
  SELECT o_orderkey AS doc_id,
    'Claimant Name: ' || c_name || chr(10) ||
    'Patient Name: ' || CASE WHEN o_orderkey % 2 = 0 THEN c_name ELSE 'Patient ' || o_custkey END || chr(10) ||
    'Phone Number: +1 614-555-0' || lpad((o_orderkey % 1000)::VARCHAR, 3, '0') || chr(10) ||
    'Policy Number: QX-' || o_orderkey || chr(10) ||
    'Incident Date: ' || CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                         ELSE strftime(o_orderdate, '%B %-d, %Y') END || chr(10) ||
    'Claim Amount: $' || format('{:,.2f}', o_totalprice) || chr(10) ||
    'Signed By: ' || c_name || chr(10) ||
    'Incident Description: ' || c_mktsegment || ' collision at lot ' || o_orderkey || '.' || chr(10) || chr(10) ||
    'Coverage on file:' || chr(10) ||
    '- Collision: Deductible: $' || format('{:,}', 250 * (1 + o_orderkey % 5)) || chr(10) ||
    '- Bodily Injury: $' || format('{:,}', 25000 * (1 + o_orderkey % 7)) || ' per person / $' ||
      format('{:,}', 50000 * (1 + o_orderkey % 7)) || ' per accident' || chr(10) ||
    '- Roadside Help: Included' || chr(10) AS text
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn after them, as question and answer."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    said = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return asked.join(said, ["conv_id", "turn"])


PAIRS_SQL = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""
