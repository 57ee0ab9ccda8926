"""Change extraction past a cursor, and half-open interval extraction.

Bounds are zone-less UTC. A cursor column with a zone, or a date, is compared under the session's
time zone, which is therefore to be UTC.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablesync.functions.coerce import ntz, utc_naive

DEFAULT_WATERMARK = datetime(1970, 1, 1)

# Cursor and delete-flag column names, in order of preference.
CURSOR_CANDIDATES = ("updated_at", "modified_at", "updated_on", "last_modified")
DELETE_FLAG_CANDIDATES = ("is_deleted", "deleted", "deleted_at")

STRICT = "strict"
INCLUSIVE = "inclusive"
BOUNDED = "bounded"


def _low(low: datetime | str, overlap: timedelta | None) -> Column:
    return ntz(utc_naive(low) - overlap if overlap else low)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Explicit column list, in ordinal order."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the columns their catalog names, whatever the reader called them."""
    return df.toDF(*names)


def is_changed(
    cursor: str,
    low: datetime | str,
    mode: str = BOUNDED,
    high: datetime | str | Column | None = None,
    overlap: timedelta | None = None,
) -> Column:
    """Whether a row is past the cursor.

    ``strict``     cursor > low
    ``inclusive``  cursor >= low, for cursors stored one microsecond past the last row
    ``bounded``    low < cursor <= high, where high was read first: a range that can be repeated

    The upper bound may be a scalar sub-query, so that bound and rows come from one lazy plan.
    Rows with a NULL cursor are never past it. ``overlap`` moves the lower bound back so rows
    that were committed late are read again; the merge is idempotent, so that is harmless.
    """
    at = F.col(f"`{cursor}`")
    bound = _low(low, overlap)
    if mode == STRICT:
        return at > bound
    if mode == INCLUSIVE:
        return (at >= bound) & at.isNotNull()
    if mode == BOUNDED:
        if high is None:
            raise ValueError("bounded extraction needs an upper bound")
        return (at > bound) & (at <= (high if isinstance(high, Column) else ntz(high)))
    raise ValueError(f"unknown cursor mode {mode!r}")


def extract_changes(
    df: DataFrame,
    cursor: str,
    low: datetime | str,
    mode: str = BOUNDED,
    high: datetime | str | Column | None = None,
    overlap: timedelta | None = None,
) -> DataFrame:
    """Rows past the cursor, see `is_changed`."""
    return df.filter(is_changed(cursor, low, mode, high, overlap))


def watched_changes(df: DataFrame, cursor: str, seen: Observation, low: datetime | str, mode: str, overlap: timedelta | None = None) -> DataFrame:
    """Rows past the cursor; the same scan counts the rows without one, which are never synced, as ``null_cursors``.

    They are counted where they are read, so that they are not shuffled; a read that is run again after the loss of
    an executor counts again.
    """
    missing = F.col(f"`{cursor}`").isNull()
    past = is_changed(cursor, low, mode, None, overlap)
    return df.filter(past | missing).observe(seen, F.count_if(missing).alias("null_cursors")).filter(past)


def bounds_of_changes(df: DataFrame, cursor: str, low: datetime | str) -> DataFrame:
    """One row: the largest cursor above ``low``, and how many rows have none; one scan of the cursor column."""
    at = F.col(f"`{cursor}`")
    some = df.select(at).filter((at > ntz(low)) | at.isNull())
    return some.agg(F.max(at).cast("timestamp_ntz").alias("upper_watermark"), F.count_if(at.isNull()).alias("null_cursors"))


def upper_watermark(df: DataFrame, cursor: str, low: datetime | str) -> DataFrame:
    """One row: the largest cursor above ``low``, NULL when nothing changed."""
    at = F.col(f"`{cursor}`")
    return df.filter(at > ntz(low)).agg(F.max(at).cast("timestamp_ntz").alias("upper_watermark"))


def next_watermark(extracted: DataFrame, cursor: str, old: datetime | str, mode: str = BOUNDED) -> DataFrame:
    """One row: the cursor to store after this batch; the old one when the batch is empty."""
    newest = F.max(F.col(f"`{cursor}`")).cast("timestamp_ntz")
    if mode == INCLUSIVE:
        newest = newest + F.expr("INTERVAL 1 MICROSECOND")
    return extracted.agg(F.coalesce(newest, ntz(old)).alias("next_watermark"))


def null_cursor_rows(df: DataFrame, cursor: str) -> DataFrame:
    """One row: how many rows can never be synced because their cursor is NULL."""
    return df.agg(F.count_if(F.col(f"`{cursor}`").isNull()).alias("null_cursor_rows"))


def order_for_files(df: DataFrame, cursor: str) -> DataFrame:
    """Sort inside each output file. A staged extract needs no total order, so nothing is shuffled
    and a cursor value shared by many rows stays spread over the tasks that read it."""
    return df.sortWithinPartitions(F.col(f"`{cursor}`"))


def order_total(df: DataFrame, cursor: str, keys: Sequence[str]) -> DataFrame:
    """Total order by cursor, then key. The key lets range partitions split inside one cursor value."""
    return df.orderBy(F.col(f"`{cursor}`"), *[F.col(f"`{k}`") for k in keys])


def in_interval(column: str, start: datetime | str, end: datetime | str) -> Column:
    at = F.col(f"`{column}`")
    return (at >= ntz(start)) & (at < ntz(end))


def extract_interval(df: DataFrame, column: str, start: datetime | str, end: datetime | str) -> DataFrame:
    return df.filter(in_interval(column, start, end))


def resolve_interval(runs: DataFrame, start: str, end: str, logical: str) -> DataFrame:
    """Interval of each run: its own when start < end, otherwise the day before its logical time."""
    own = F.col(start) < F.col(end)
    return runs.withColumns(
        {
            "interval_start": F.when(own, F.col(start)).otherwise(F.col(logical) - F.expr("INTERVAL 1 DAY")),
            "interval_end": F.when(own, F.col(end)).otherwise(F.col(logical)),
        }
    )


def changed_only(batches: DataFrame, count_column: str = "row_count") -> DataFrame:
    """Keep the tables that have changes."""
    return batches.filter(F.col(count_column) > 0)
