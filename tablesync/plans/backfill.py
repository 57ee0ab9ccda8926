"""Interval backfill: replace ``[start, end)`` of a table, as often as one likes."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tablesync.functions.coerce import utc_naive
from tablesync.operators.extract import extract_interval
from tablesync.operators.interval import replace_interval
from tablesync.operators.quality import require_equal
from tablesync.plans import files
from tablesync.plans.full_load import RETENTION
from tablesync.plans.livetable import DaySlices, LiveTable
from tablesync.plans.staging import gate, run_directory, stage


def run_interval(
    start: datetime | str, end: datetime | str, logical: datetime | str
) -> tuple[datetime, datetime]:
    """The run's own interval, or the day before its logical time when that is empty. Offsets are
    applied here, once; from here on times are zone-less UTC."""
    low, high, at = utc_naive(start), utc_naive(end), utc_naive(logical)
    return (low, high) if low < high else (at - timedelta(days=1), at)


def backfill(
    spark: SparkSession,
    source: DataFrame,
    column: str,
    live: LiveTable,
    staging_root: str,
    start: datetime | str,
    end: datetime | str,
    run_id: str,
    retention: float = RETENTION,
) -> int:
    """Replace one interval and return its row count. An interval without source rows is emptied.

    A table sliced by day on the interval column rewrites only the days the interval touches. The
    gate runs on the written version, before it goes live.
    """
    live.ensure(source.schema)
    by_day = isinstance(live.slices, DaySlices) and live.slices.time_column == column
    touched = live.slices.days(start, end) if by_day else None
    with run_directory(spark, staging_root, run_id, live.name) as staging:
        batch = stage(extract_interval(source, column, start, end), source.schema, staging)
        gate(spark, batch, live.name)
        content = replace_interval(live.read(touched), batch.read(spark), column, start, end)
        path = live.write_version(content, run_id)
        try:
            loaded = extract_interval(live.read_version(path), column, start, end).count()
            require_equal(f"{live.name}: rows in the interval", batch.rows, loaded)
        except Exception:
            files.delete_dir(spark, path)
            raise
        live.publish(path, touched)
    live.expire(retention)
    return loaded
