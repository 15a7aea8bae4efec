"""Sending this package to the executors of a session.

Functions that run inside tasks are looked up by module name there. A cluster
job submitted with ``--py-files`` has the package already; any other session
gets it here, once.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="paperloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(str(Path(folder) / package.name), "zip", root_dir=package.parent, base_dir=package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
