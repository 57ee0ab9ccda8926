"""Idempotent replacement of a half-open time interval."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.extract import extract_interval, in_interval
from tablesync.operators.merge import align


def outside_interval(target: DataFrame, column: str, start: datetime | str, end: datetime | str) -> DataFrame:
    """Rows a delete of ``[start, end)`` leaves, including rows without a time."""
    return target.filter(~F.coalesce(in_interval(column, start, end), F.lit(False)))


def replace_interval(
    target: DataFrame, batch: DataFrame, column: str, start: datetime | str, end: datetime | str
) -> DataFrame:
    """Target with ``[start, end)`` replaced by the batch; an empty batch still deletes."""
    kept = outside_interval(target, column, start, end)
    return kept.unionByName(align(batch, target), allowMissingColumns=True)


def interval_count(df: DataFrame, column: str, start: datetime | str, end: datetime | str) -> DataFrame:
    return extract_interval(df, column, start, end).agg(F.count("*").alias("interval_rows"))
