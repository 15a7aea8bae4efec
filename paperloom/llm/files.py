"""Files in a folder that all tasks share, opened by the URI Spark knows it by."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import SparkSession

# Names that Spark's connectors give to stores which have another one here.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def shared_folder(spark: SparkSession, folder: str) -> str:
    """``folder`` as a full URI, made if it is not there.

    A path without a scheme is one of Spark's default file system, which need
    not be a local disk. Raises ValueError on the driver, before any task runs,
    for a file system that tasks could not open.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(path).toString()
    try:
        opened(uri)
    except Exception as e:
        raise ValueError(f"tasks cannot write files to {uri}: {e}") from e
    system.mkdirs(path)
    return uri


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a full URI, and the path in it."""
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
