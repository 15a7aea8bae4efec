"""Appending columns that Python computes from one column of each row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.shipping import ship_package

# Rows and bytes of text that a task works on at once.
SLICE_ROWS, SLICE_BYTES = 512, 4 << 20


def without(columns: list[str], taken: list[str]) -> list[str]:
    """``columns`` that do not clash with ``taken``; names differ by more than case."""
    names = {c.lower() for c in taken}
    return [c for c in columns if c.lower() not in names]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Columns of ``df`` (all by default) as one, ``_row``, so that no name of theirs is in the way."""
    return F.struct(F.lit(0).alias("_"), *[F.col(quoted(c)) for c in (df.columns if columns is None else columns)]).alias("_row")


def unpacked(columns: list[str]) -> list[Column]:
    return [F.col(f"_row.{quoted(c)}") for c in columns]


def append_columns(
    df: DataFrame, column: str, make: Callable[[], Callable[[pa.Array], list]], schema: T.StructType, keep: list[str] | None = None
) -> DataFrame:
    """``df`` with the columns of ``schema`` computed from ``column``.

    ``make`` runs once in each task and returns a function from the values of a
    batch to one list or array per new column. ``keep`` names the columns of
    ``df`` that stay (all by default); a new column replaces one of its name.
    The values themselves go to Python once, also where ``column`` is kept.
    What a task holds is bounded by ``SLICE_ROWS`` and ``SLICE_BYTES``, or by
    one row where that is larger.
    """
    ship_package(df.sparkSession)
    kept = without(df.columns if keep is None else keep, schema.fieldNames())
    source = df.select(packed(df, [c for c in kept if c != column]), F.col(quoted(column)).alias("_value"))
    carried = list(source.schema.fields) if column in kept else [source.schema["_row"]]
    whole = T.StructType([*carried, *schema.fields])
    types = [_arrow(f.dataType) for f in schema.fields]
    names = whole.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in _slices(batch):
                made = work(part.column(1))
                arrays = [a if isinstance(a, pa.Array) else pa.array(a, t) for a, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(carried)], *arrays], names=names)

    out = source.mapInArrow(run, whole)
    back = [F.col("_value").alias(c) if c == column else unpacked([c])[0] for c in kept]
    return out.select(*back, *[F.col(quoted(c)) for c in schema.fieldNames()])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of bounded rows and bytes of its values."""
    values = batch.column(1)
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)) if pa.types.is_string(values.type) else np.zeros(len(values))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        end = min(start + SLICE_ROWS, max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right"))), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in kind.fields])
    return simple[kind.simpleString()]
