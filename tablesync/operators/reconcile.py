"""Source against target: counts, differences and the records kept of them."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.coerce import ntz
from tablesync.functions.status import count_status

# The columns of the two histories (the last one of the second is an addition).
FULL_LOAD_HISTORY = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_type", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("pg_count", T.LongType()),
        T.StructField("sf_count", T.LongType()),
        T.StructField("count_diff", T.LongType()),
        T.StructField("extracted_count", T.LongType()),
        T.StructField("staged_count", T.LongType()),
        T.StructField("watermark", T.TimestampNTZType()),
        T.StructField("error_message", T.StringType()),
    ]
)

CDC_HISTORY = T.StructType(
    [
        T.StructField("dag_run_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("checked_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_row_count", T.LongType()),
        T.StructField("target_row_count", T.LongType()),
        T.StructField("row_count_diff", T.LongType()),
        T.StructField("cdc_row_count", T.LongType()),
        T.StructField("inserted_row_count", T.LongType()),
        T.StructField("updated_row_count", T.LongType()),
        T.StructField("deleted_row_count", T.LongType()),
        T.StructField("last_watermark", T.TimestampNTZType()),
        T.StructField("last_cdc_run_at", T.TimestampNTZType()),
        T.StructField("null_cursor_row_count", T.LongType()),
    ]
)


def _at(moment: datetime | Column) -> Column:
    return moment if isinstance(moment, Column) else ntz(moment)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of several tables in one job; each scan reads no columns."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile_counts(source: DataFrame, target: DataFrame, unequal: str) -> DataFrame:
    """Two (table_name, row_count) frames side by side. A table missing on one side counts 0 there."""
    left = source.select("table_name", F.col("row_count").alias("source_count"))
    right = target.select("table_name", F.col("row_count").alias("target_count"))
    both = left.join(right, "table_name", "full_outer").select(
        "table_name",
        F.coalesce("source_count", F.lit(0)).alias("source_count"),
        F.coalesce("target_count", F.lit(0)).alias("target_count"),
    )
    diff = F.col("source_count") - F.col("target_count")
    return both.withColumn("count_diff", diff).withColumn("status", count_status(F.col("count_diff"), unequal))


def full_load_records(
    reconciled: DataFrame, run_id: str, start: datetime | Column, end: datetime | Column, staged: DataFrame | None = None
) -> DataFrame:
    """History rows of a full load. ``staged`` is (table_name, extracted_count, staged_count), and
    may carry further columns for ``start`` and ``end`` to refer to."""
    df = reconciled
    if staged is not None:
        df = df.join(staged, "table_name", "left")
    else:
        df = df.withColumns({c: F.lit(None).cast("bigint") for c in ("extracted_count", "staged_count")})
    message = F.concat(
        F.col("table_name"), F.lit(" mismatch: source="), F.col("source_count").cast("string"),
        F.lit(", target="), F.col("target_count").cast("string"),
    )
    return df.select(
        F.lit(run_id).alias("run_id"),
        F.lit("FULL_LOAD").alias("pipeline_type"),
        "table_name",
        _at(start).alias("start_time"),
        _at(end).alias("end_time"),
        "status",
        F.col("source_count").alias("pg_count"),
        F.col("target_count").alias("sf_count"),
        "count_diff",
        "extracted_count",
        "staged_count",
        F.lit(None).cast("timestamp_ntz").alias("watermark"),
        F.when(F.col("count_diff") != 0, message).alias("error_message"),
    )


def cdc_records(
    reconciled: DataFrame, changes: DataFrame, control: DataFrame, run_id: str, checked_at: datetime
) -> DataFrame:
    """History rows of a sync: counts of both sides, change counts and the stored cursor.

    ``changes`` is (table_name, cdc_row_count, inserted_row_count, updated_row_count,
    deleted_row_count) and, where it is known, null_cursor_row_count; tables without changes may be absent.
    """
    nulls = [c for c in ("null_cursor_row_count",) if c in changes.columns]
    zero = {
        c: F.coalesce(c, F.lit(0)).cast("bigint")
        for c in ("cdc_row_count", "inserted_row_count", "updated_row_count", "deleted_row_count")
    }
    stored = control.select("table_name", "last_watermark", F.col("last_run_at").alias("last_cdc_run_at"))
    df = reconciled.join(changes, "table_name", "left").join(stored, "table_name", "left").withColumns(zero)
    return df.select(
        F.lit(run_id).alias("dag_run_id"),
        "table_name",
        ntz(checked_at).alias("checked_at"),
        "status",
        F.col("source_count").alias("source_row_count"),
        F.col("target_count").alias("target_row_count"),
        F.col("count_diff").alias("row_count_diff"),
        *zero,
        "last_watermark",
        "last_cdc_run_at",
        *nulls,
    )
