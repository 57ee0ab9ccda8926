"""Small frames of bookkeeping rows: one per table or run, never data."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def small_frame(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A local relation, so that joins with it need no Python worker and see its real size."""
    if not rows:
        return spark.createDataFrame([], schema)
    columns = {name: list(values) for name, values in zip(schema.names, zip(*rows))}
    return spark.createDataFrame(pa.table(columns), schema)


def rows_frame(spark: SparkSession, rows: Sequence[dict], schema: T.StructType) -> DataFrame:
    """A small frame from dictionaries; what they lack is NULL."""
    return small_frame(spark, [tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
