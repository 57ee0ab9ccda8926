"""Cursor modes at their boundaries, intervals, watermarks."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablesync.operators import extract as ex
from tablesync.operators.interval import replace_interval
from tablesync.plans.backfill import run_interval
from tablesync.plans.livetable import DaySlices

EPOCH = datetime(1970, 1, 1)
LOW = datetime(2024, 1, 1)
HIGH = datetime(2024, 1, 3)

ROWS = [
    (1, EPOCH),
    (2, LOW),
    (3, LOW + timedelta(microseconds=1)),
    (4, HIGH),
    (5, HIGH + timedelta(microseconds=1)),
    (6, None),
]


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(ROWS, "id long, updated_at timestamp_ntz")


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize(
    ("mode", "low", "high", "want"),
    [
        (ex.STRICT, LOW, None, [3, 4, 5]),
        (ex.INCLUSIVE, LOW, None, [2, 3, 4, 5]),
        (ex.BOUNDED, LOW, HIGH, [3, 4]),
        (ex.STRICT, EPOCH, None, [2, 3, 4, 5]),
        (ex.INCLUSIVE, EPOCH, None, [1, 2, 3, 4, 5]),
        (ex.BOUNDED, EPOCH, HIGH, [2, 3, 4]),
    ],
)
def test_modes_at_the_bounds(rows, mode, low, high, want):
    assert ids(ex.extract_changes(rows, "updated_at", low, mode, high)) == want


def test_inclusive_with_stored_microsecond_equals_strict(rows):
    stored = LOW + timedelta(microseconds=1)
    assert ids(ex.extract_changes(rows, "updated_at", stored, ex.INCLUSIVE)) == ids(
        ex.extract_changes(rows, "updated_at", LOW, ex.STRICT)
    )


def test_bounded_needs_an_upper_bound(rows):
    with pytest.raises(ValueError):
        ex.extract_changes(rows, "updated_at", LOW)
    with pytest.raises(ValueError):
        ex.extract_changes(rows, "updated_at", LOW, "sometimes", HIGH)


def test_overlap_reads_again(rows):
    got = ex.extract_changes(rows, "updated_at", LOW, ex.STRICT, overlap=timedelta(days=1))
    assert ids(got) == [2, 3, 4, 5]


def test_null_cursor_rows_are_counted(rows):
    assert ex.null_cursor_rows(rows, "updated_at").first()[0] == 1


def test_next_watermark(rows):
    past = rows.filter("id <= 4")
    assert ex.next_watermark(past, "updated_at", EPOCH).first()[0] == HIGH
    assert ex.next_watermark(past, "updated_at", EPOCH, ex.INCLUSIVE).first()[0] == HIGH + timedelta(microseconds=1)
    assert ex.next_watermark(rows.filter("id = 6"), "updated_at", LOW).first()[0] == LOW
    assert ex.next_watermark(rows.filter("false"), "updated_at", LOW).first()[0] == LOW


def test_upper_watermark_ignores_nulls_and_older(rows):
    assert ex.upper_watermark(rows, "updated_at", LOW).first()[0] == HIGH + timedelta(microseconds=1)
    assert ex.upper_watermark(rows, "updated_at", datetime(2030, 1, 1)).first()[0] is None


def test_scan_gets_the_filter(spark, tmp_path, rows):
    rows.write.parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    got = ex.extract_changes(spark.read.parquet(f"{tmp_path}/t"), "updated_at", LOW, ex.BOUNDED, HIGH)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at,2024-01-01T00:00)" in plan and "LessThanOrEqual(updated_at,2024-01-03T00:00)" in plan


def test_run_interval():
    assert run_interval("2024-01-01T00:00:00+00:00", "2024-01-02T00:00:00+00:00", LOW) == (LOW, datetime(2024, 1, 2))
    assert run_interval(LOW, LOW, "2024-01-05T09:00:00+09:00") == (datetime(2024, 1, 4), datetime(2024, 1, 5))


def test_days_an_interval_touches():
    days = DaySlices.days
    assert days(LOW, datetime(2024, 1, 2)) == [date(2024, 1, 1)]
    assert days(datetime(2024, 1, 1, 12), datetime(2024, 1, 2, 0, 0, 0, 1)) == [date(2024, 1, 1), date(2024, 1, 2)]
    assert days(LOW, LOW) == []


def test_interval_replace_is_half_open_and_keeps_rows_without_time(rows):
    batch = rows.filter("id = 2").select(F.lit(20).cast("long").alias("id"), "updated_at")
    once = replace_interval(rows, batch, "updated_at", LOW, HIGH)
    assert ids(once) == [1, 4, 5, 6, 20]
    assert ids(replace_interval(once, batch, "updated_at", LOW, HIGH)) == [1, 4, 5, 6, 20]
    assert ids(replace_interval(once, batch.filter("false"), "updated_at", LOW, HIGH)) == [1, 4, 5, 6]
