import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

# task functions defined in test modules are looked up by name in the workers
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parent), os.environ.get("PYTHONPATH", "")])

from compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session("8")


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one column for one row of named values."""

    def run(column, schema="x int", *values):
        row = spark.createDataFrame([values or (1,)], schema)
        return row.select(column.alias("v")).first()["v"]

    return run
