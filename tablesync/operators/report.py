"""Reports over the two run histories.

Column names are matched without case, so the operators take the histories as stored or with
upper-cased names.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.functions.coerce import ntz, number_or_zero, timestamp_or_null
from tablesync.functions.status import display_status, status_is

ALL = "ALL"
FULL_LOAD = "FULL_LOAD"
CDC = "CDC"

# Columns of the report views and the names they are shown under.
CDC_VIEW = {
    "TABLE_NAME": "Table",
    "STATUS_DISPLAY": "상태",
    "SOURCE_ROW_COUNT": "Source",
    "TARGET_ROW_COUNT": "Target",
    "ROW_COUNT_DIFF": "차이",
    "CDC_ROW_COUNT": "이번 CDC",
    "LAST_CDC_RUN_AT": "마지막 CDC",
    "LAST_WATERMARK": "Watermark",
}
ATTENTION_VIEW = {
    "TABLE_NAME": "Table",
    "STATUS": "Status",
    "SOURCE_ROW_COUNT": "Source",
    "TARGET_ROW_COUNT": "Target",
    "ROW_COUNT_DIFF": "차이",
    "CDC_ROW_COUNT": "이번 CDC",
    "LAST_CDC_RUN_AT": "마지막 CDC",
}
RECENT_VIEW = {
    "TABLE_NAME": "Table",
    "CHECKED_AT": "확인 시간",
    "STATUS_DISPLAY": "상태",
    "CDC_ROW_COUNT": "이번 CDC",
    "ROW_COUNT_DIFF": "Source/Target 차이",
}
FULL_VIEW = {
    "TABLE_NAME": "Table",
    "STATUS_DISPLAY": "상태",
    "PG_COUNT": "Source",
    "SF_COUNT": "Target",
    "COUNT_DIFF": "차이",
    "START_TIME": "시작",
    "END_TIME": "종료",
}
FULL_COUNTS = ("PG_COUNT", "SF_COUNT", "COUNT_DIFF", "EXTRACTED_COUNT", "STAGED_COUNT")
CDC_COUNTS = ("SOURCE_ROW_COUNT", "TARGET_ROW_COUNT", "ROW_COUNT_DIFF", "CDC_ROW_COUNT")


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def coerce_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count columns as numbers, 0 where they are missing or no number. Absent columns are skipped."""
    have = {c.upper(): c for c in df.columns}
    wanted = [have[c.upper()] for c in columns if c.upper() in have]
    return df.withColumns({c: number_or_zero(df, c) for c in wanted})


def history(df: DataFrame, time_column: str, tiebreak: str) -> DataFrame:
    """Newest first; the tiebreak makes the order total and lets a hot time value be split."""
    return df.orderBy(F.col(time_column).desc_nulls_last(), F.col(tiebreak))


def filter_status(df: DataFrame, status: str) -> DataFrame:
    return df if status == ALL else df.filter(status_is(F.col("status"), status))


def filter_table(df: DataFrame, table: str) -> DataFrame:
    return df if table == ALL else df.filter(F.col("table_name") == table)


def filter_kind(df: DataFrame, kind: str, selected: str) -> DataFrame:
    """A history that is not selected becomes empty but keeps its columns."""
    return df if selected in (ALL, kind) else df.filter(F.lit(False))


def filtered(df: DataFrame, kind: str, selected: str = ALL, status: str = ALL, table: str = ALL) -> DataFrame:
    """All three report filters. They apply before the latest run is picked, so a status filter
    shows each table's latest run *with that status*."""
    return filter_table(filter_status(filter_kind(df, kind, selected), status), table)


def latest_per(df: DataFrame, columns: Sequence[str], time_column: str, tiebreak: str) -> DataFrame:
    """Latest run of each group; unreadable times sort last, runs without a value form a group of their own. Spark limits each
    group to one row before the shuffle, so a hot table does not pile up."""
    newest = Window.partitionBy(*columns).orderBy(timestamp_or_null(F.col(time_column)).desc_nulls_last(), F.col(tiebreak))
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def latest_per_table(df: DataFrame, time_column: str, tiebreak: str) -> DataFrame:
    """Latest run of each table; runs without a table name form one group."""
    return latest_per(df, ("table_name",), time_column, tiebreak)


def _ok(diff: Column) -> Column:
    return status_is(F.col("status"), "SUCCESS") & (diff == 0)


def _kpis(latest: DataFrame, diff_column: str, ok: Column, diff: Column) -> DataFrame:
    failed = status_is(F.col("status"), "FAILED")
    return latest.agg(
        F.count("*").alias("table_count"),
        F.count_if(ok).alias("ok_count"),
        F.count_if(failed).alias("failed_count"),
        F.count_if(diff != 0).alias("mismatch_count"),
        # the two counts overlap: a failed run with a difference is in both
        (F.count_if(failed) + F.count_if(diff != 0)).alias("mismatch_plus_failed"),
        F.count_if(failed | (diff != 0)).alias("problem_tables"),
    )


def cdc_kpis(latest: DataFrame) -> DataFrame:
    """One row of figures over the latest sync of each table; OK needs success and no difference."""
    diff = number_or_zero(latest, "row_count_diff")
    return _kpis(latest, "row_count_diff", _ok(diff), diff)


def full_kpis(latest: DataFrame) -> DataFrame:
    """The same over the latest full loads, where OK is the status alone."""
    diff = number_or_zero(latest, "count_diff")
    return _kpis(latest, "count_diff", status_is(F.col("status"), "SUCCESS"), diff)


def today_changes(df: DataFrame, as_of: datetime) -> DataFrame:
    """One row: changed rows of all runs since the start of the day of ``as_of``."""
    day = ntz(as_of.replace(hour=0, minute=0, second=0, microsecond=0))
    today = df.filter(timestamp_or_null(F.col("checked_at")) >= day)
    changes = F.sum(number_or_zero(today, "cdc_row_count").cast("bigint"))
    return today.agg(F.coalesce(changes, F.lit(0)).alias("today_change_count"))


def dq_summary(latest_cdc: DataFrame, latest_full: DataFrame) -> DataFrame:
    """One row over both histories: mismatches, failures and whether all is clear.

    Both sides are reduced to (kind, failed, differs) and counted in one aggregate, so no join of
    any kind is needed.
    """

    def flags(df: DataFrame, kind: str, diff: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"),
            status_is(F.col("status"), "FAILED").alias("failed"),
            (number_or_zero(df, diff) != 0).alias("differs"),
        )

    both = flags(latest_cdc, CDC, "row_count_diff").unionByName(flags(latest_full, FULL_LOAD, "count_diff"))

    def count(kind: str, what: str) -> Column:
        return F.count_if((F.col("kind") == kind) & F.col(what))

    totals = both.agg(
        count(CDC, "differs").alias("cdc_mismatch"),
        count(CDC, "failed").alias("cdc_failed"),
        count(FULL_LOAD, "differs").alias("full_mismatch"),
        count(FULL_LOAD, "failed").alias("full_failed"),
    )
    problems = F.col("cdc_mismatch") + F.col("cdc_failed") + F.col("full_mismatch") + F.col("full_failed")
    return totals.withColumns(
        {"full_problems": F.col("full_mismatch") + F.col("full_failed"), "all_clear": problems == 0}
    )


def with_display(df: DataFrame, diff_column: str, name: str = "status_display") -> DataFrame:
    return df.withColumn(name, display_status(F.col("status"), F.col(diff_column)))


def view(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select the columns that are present, in the view's order, under their display names."""
    have = {c.upper(): c for c in df.columns}
    return df.select(*[F.col(f"`{have[c]}`").alias(shown) for c, shown in columns.items() if c in have])


def recent_activity(df: DataFrame, tiebreak: str, rows: int = 20) -> DataFrame:
    """The most recent runs: a top-k per task and a merge, never a full sort."""
    return df.orderBy(timestamp_or_null(F.col("checked_at")).desc_nulls_last(), F.col(tiebreak)).limit(rows)


def attention(latest: DataFrame, diff_column: str = "row_count_diff") -> DataFrame:
    """Latest runs that failed or differ."""
    return latest.filter(status_is(F.col("status"), "FAILED") | (number_or_zero(latest, diff_column) != 0))


def options(column: str, *histories: DataFrame) -> DataFrame:
    """Distinct values of a column over several histories, sorted, without NULL. Each task
    reduces its rows to distinct values before they are shuffled."""
    values = None
    for df in histories:
        part = df.select(F.col(column).cast("string").alias(column))
        values = part if values is None else values.unionByName(part)
    return values.filter(F.col(column).isNotNull()).distinct().orderBy(column)
