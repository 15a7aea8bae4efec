"""Stage tables: results that several consumers read, written once.

A stage table lives in the folder named by ``spark.checkpoint.dir``, which all
executors share, so losing an executor loses no result and no lineage has to
be replayed (in particular no model is called twice).
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of a table that is broadcast at most.
MAX_BROADCAST_BYTES = 64 << 20
# A task that ends moves what it wrote to the folder at once, and a job that breaks off leaves that there.
COMMIT_BY_TASK = ("mapreduce.fileoutputcommitter.algorithm.version", "2")
CHECKPOINT_SETTING = "spark.checkpoint.dir"

_own_folder: str | None = None


def stage_folder(spark: SparkSession) -> str:
    """The shared folder; on a local session without one, a folder of our own."""
    global _own_folder
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="paperloom-")
        atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
    return _own_folder


def stage_path(spark: SparkSession, name: str) -> str:
    """A path nobody used before, for one stage table called ``name``."""
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


_staged: list[str] = []


def remove_stages(spark: SparkSession) -> int:
    """Delete the stage tables this process has written; what reads them is no longer of use.

    Runs when the process ends, as far as its session still lives then, and
    takes the folders of ``scratch_path`` with it. Paths asked for by
    ``stage_path`` belong to the caller and stay.
    """
    removed = 0
    while _staged:
        path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed


def _remove_at_exit() -> None:
    session = SparkSession.getActiveSession()
    if session is not None and _staged:
        with contextlib.suppress(Exception):  # the gateway may be gone first
            remove_stages(session)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for working tables, removed as stage tables are."""
    path = stage_path(spark, name)
    if not _staged:
        atexit.unregister(_remove_at_exit)
        atexit.register(_remove_at_exit)  # after the session's own, so that it runs before
    _staged.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def held_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session with another setting, for what is run within."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _bytes(name: str, kind: T.DataType) -> Column:
    """About how many bytes a value takes."""
    value = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 24
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        return F.greatest(F.size(value), F.lit(0)) * 8 + 24
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0)) + 24
    return F.lit(8)


def fits(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` is within both bounds; reads no more rows than needed."""
    size = sum((_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(0)).cast("bigint")
    rows, total = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and total <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after rows and bytes were checked."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that are evaluated once per row, whoever reads them.

    Filters on them and projections over them would otherwise repeat their
    expressions; the output of a generator is not taken apart again.
    """
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select("*", made.alias("_once")).select(*df.columns, "_once.*")
