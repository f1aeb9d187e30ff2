"""Running Python on Arrow batches inside Spark's tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def map_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``df.mapInArrow`` with workers that find this package where the driver does.

    On a cluster the package is installed or sent along; then the path changes nothing.
    """
    environment = df.sparkSession.sparkContext.environment
    root, paths = str(Path(__file__).resolve().parents[2]), environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])
    return df.mapInArrow(run, schema)


def fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def batch(schema: T.StructType, *columns) -> pa.RecordBatch:
    """A batch with the names of ``schema``."""
    arrays = [column if isinstance(column, pa.Array) else pa.array(column) for column in columns]
    return pa.RecordBatch.from_arrays(arrays, schema.fieldNames())
