"""Report queries over the two run histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions import status as st
from tablesync.functions.coerce import timestamp_or_null
from tablesync.operators import report as rp
from workload import inputs as i
from workload.registry import query

_LATEST_CDC = f"""{i.CDC_H}, latest_cdc AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY checked_at DESC NULLS LAST, dag_run_id) AS rn FROM cdc_h)
  WHERE rn = 1)"""
_LATEST_FULL = f"""{i.FULL_H}, latest_full AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY start_time DESC NULLS LAST, run_id) AS rn FROM full_h)
  WHERE rn = 1)"""


def _latest_cdc(spark: SparkSession, sf: str) -> DataFrame:
    return rp.latest_per_table(i.cdc_history(spark, sf), "checked_at", "dag_run_id")


def _latest_full(spark: SparkSession, sf: str) -> DataFrame:
    return rp.latest_per_table(i.full_history(spark, sf), "start_time", "run_id")


def _display(diff: str) -> str:
    return (
        f"CASE WHEN upper(status) = 'FAILED' THEN '{st.LABEL_FAILED}' WHEN {diff} <> 0 THEN '{st.LABEL_MISMATCH}' "
        f"ELSE '{st.LABEL_OK}' END"
    )


@query("full_history", f"WITH {i.FULL_H} SELECT * FROM full_h ORDER BY start_time DESC, run_id")
def full_history(spark: SparkSession, sf: str) -> DataFrame:
    return rp.history(i.full_history(spark, sf), "start_time", "run_id")


@query("cdc_history", f"WITH {i.CDC_H} SELECT * FROM cdc_h ORDER BY checked_at DESC, dag_run_id")
def cdc_history(spark: SparkSession, sf: str) -> DataFrame:
    return rp.history(i.cdc_history(spark, sf), "checked_at", "dag_run_id")


@query("filter_status", f"WITH {i.CDC_H} SELECT * FROM cdc_h WHERE upper(status) = 'FAILED'")
def filter_status(spark: SparkSession, sf: str) -> DataFrame:
    return rp.filtered(i.cdc_history(spark, sf), rp.CDC, status="Failed")


@query("filter_table", f"WITH {i.CDC_H} SELECT * FROM cdc_h WHERE table_name = 't7'")
def filter_table(spark: SparkSession, sf: str) -> DataFrame:
    return rp.filtered(i.cdc_history(spark, sf), rp.CDC, table="t7")


@query(
    "filter_pipeline",
    f"WITH {i.FULL_H} SELECT 'FULL_LOAD' AS kind, run_id, table_name, status FROM full_h",
)
def filter_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """FULL_LOAD is selected: the other history turns empty but keeps its columns."""
    full = rp.filtered(i.full_history(spark, sf), rp.FULL_LOAD, selected=rp.FULL_LOAD)
    cdc = rp.filtered(i.cdc_history(spark, sf), rp.CDC, selected=rp.FULL_LOAD)
    return full.select(F.lit(rp.FULL_LOAD).alias("kind"), "run_id", "table_name", "status").unionByName(
        cdc.select(F.lit(rp.CDC).alias("kind"), F.col("dag_run_id").alias("run_id"), "table_name", "status")
    )


@query(
    "normalize_columns",
    f"""WITH {i.FULL_H} SELECT run_id AS RUN_ID, pipeline_type AS PIPELINE_TYPE, table_name AS TABLE_NAME, start_time AS START_TIME,
    end_time AS END_TIME, status AS STATUS, pg_count AS PG_COUNT, sf_count AS SF_COUNT, count_diff AS COUNT_DIFF FROM full_h""",
)
def normalize_columns(spark: SparkSession, sf: str) -> DataFrame:
    return rp.normalize_columns(i.full_history(spark, sf))


def _text_counts(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("status") == "MISMATCH", "n/a").when(F.col("status") == "SUCCESS", F.col("source_row_count").cast("string"))
    return i.cdc_history(spark, sf).select("dag_run_id", text.alias("source_row_count"), "row_count_diff")


@query(
    "numeric_coerce",
    f"""WITH {i.CDC_H}, t AS (SELECT dag_run_id, CASE status WHEN 'MISMATCH' THEN 'n/a' WHEN 'SUCCESS' THEN CAST(source_row_count AS VARCHAR) END AS c,
      row_count_diff FROM cdc_h)
    SELECT dag_run_id, coalesce(TRY_CAST(c AS DOUBLE), 0) AS source_row_count, row_count_diff FROM t""",
)
def numeric_coerce(spark: SparkSession, sf: str) -> DataFrame:
    return rp.coerce_counts(_text_counts(spark, sf), rp.CDC_COUNTS)


@query(
    "timestamp_coerce",
    f"""WITH {i.CDC_H}, t AS (SELECT dag_run_id, CASE status WHEN 'MISMATCH' THEN 'not a time' ELSE CAST(checked_at AS VARCHAR) END AS c FROM cdc_h)
    SELECT dag_run_id, TRY_CAST(c AS TIMESTAMP) AS checked_at FROM t""",
)
def timestamp_coerce(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("status") == "MISMATCH", "not a time").otherwise(F.col("checked_at").cast("string"))
    return i.cdc_history(spark, sf).select("dag_run_id", timestamp_or_null(text).alias("checked_at"))


@query("status_display", f"WITH {i.CDC_H} SELECT dag_run_id, status, row_count_diff, {_display('row_count_diff')} AS status_display FROM cdc_h")
def status_display(spark: SparkSession, sf: str) -> DataFrame:
    rows = i.cdc_history(spark, sf).select("dag_run_id", "status", "row_count_diff")
    return rp.with_display(rows, "row_count_diff")


@query(
    "report_projection",
    f"""WITH {_LATEST_CDC} SELECT table_name AS "Table", {_display('row_count_diff')} AS "상태", source_row_count AS "Source",
    target_row_count AS "Target", row_count_diff AS "차이", cdc_row_count AS "이번 CDC", last_cdc_run_at AS "마지막 CDC",
    last_watermark AS "Watermark" FROM latest_cdc""",
)
def report_projection(spark: SparkSession, sf: str) -> DataFrame:
    return rp.view(rp.with_display(_latest_cdc(spark, sf), "row_count_diff"), rp.CDC_VIEW)


@query(
    "full_report_projection",
    f"""WITH {_LATEST_FULL} SELECT table_name AS "Table", {_display('count_diff')} AS "상태", pg_count AS "Source",
    sf_count AS "Target", count_diff AS "차이", start_time AS "시작", end_time AS "종료" FROM latest_full""",
)
def full_report_projection(spark: SparkSession, sf: str) -> DataFrame:
    return rp.view(rp.with_display(_latest_full(spark, sf), "count_diff"), rp.FULL_VIEW)


@query("latest_per_key", f"WITH {_LATEST_FULL} SELECT * FROM latest_full")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return _latest_full(spark, sf)


@query(
    "latest_with_status",
    f"""WITH {i.CDC_H} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY table_name
      ORDER BY checked_at DESC NULLS LAST, dag_run_id) AS rn FROM cdc_h WHERE upper(status) = 'SUCCESS') WHERE rn = 1""",
)
def latest_with_status(spark: SparkSession, sf: str) -> DataFrame:
    """Filters come first, so this is each table's latest successful run."""
    kept = rp.filtered(i.cdc_history(spark, sf), rp.CDC, status="SUCCESS")
    return rp.latest_per_table(kept, "checked_at", "dag_run_id")


def _kpi_sql(diff: str, ok: str) -> str:
    failed = "upper(status) = 'FAILED'"
    return f"""SELECT count(*) AS table_count, count(*) FILTER (WHERE {ok}) AS ok_count,
    count(*) FILTER (WHERE {failed}) AS failed_count, count(*) FILTER (WHERE {diff} <> 0) AS mismatch_count,
    count(*) FILTER (WHERE {failed}) + count(*) FILTER (WHERE {diff} <> 0) AS mismatch_plus_failed,
    count(*) FILTER (WHERE {failed} OR {diff} <> 0) AS problem_tables"""


@query("cdc_kpis", f"WITH {_LATEST_CDC} {_kpi_sql('row_count_diff', 'upper(status) = $$SUCCESS$$ AND row_count_diff = 0')} FROM latest_cdc")
def cdc_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return rp.cdc_kpis(_latest_cdc(spark, sf))


@query("full_kpis", f"WITH {_LATEST_FULL} {_kpi_sql('count_diff', 'upper(status) = $$SUCCESS$$')} FROM latest_full")
def full_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return rp.full_kpis(_latest_full(spark, sf))


@query(
    "today_changes",
    f"WITH {i.CDC_H} SELECT CAST(coalesce(sum(cdc_row_count), 0) AS BIGINT) AS today_change_count FROM cdc_h WHERE checked_at >= {i.SQL_AS_OF}",
)
def today_changes(spark: SparkSession, sf: str) -> DataFrame:
    return rp.today_changes(i.cdc_history(spark, sf), i.CHECKED_AT)


@query(
    "dq_summary",
    f"""WITH {_LATEST_CDC}, {_LATEST_FULL},
    c AS (SELECT count(*) FILTER (WHERE row_count_diff <> 0) AS cdc_mismatch, count(*) FILTER (WHERE upper(status) = 'FAILED') AS cdc_failed FROM latest_cdc),
    f AS (SELECT count(*) FILTER (WHERE count_diff <> 0) AS full_mismatch, count(*) FILTER (WHERE upper(status) = 'FAILED') AS full_failed FROM latest_full)
    SELECT *, full_mismatch + full_failed AS full_problems, cdc_mismatch + cdc_failed + full_mismatch + full_failed = 0 AS all_clear FROM c, f""",
)
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rp.dq_summary(_latest_cdc(spark, sf), _latest_full(spark, sf))


@query(
    "recent_activity",
    f"""WITH {i.CDC_H} SELECT table_name AS "Table", checked_at AS "확인 시간", {_display('row_count_diff')} AS "상태",
    cdc_row_count AS "이번 CDC", row_count_diff AS "Source/Target 차이"
    FROM (SELECT * FROM cdc_h ORDER BY checked_at DESC NULLS LAST, dag_run_id LIMIT 20)""",
)
def recent_activity(spark: SparkSession, sf: str) -> DataFrame:
    recent = rp.recent_activity(i.cdc_history(spark, sf), "dag_run_id")
    return rp.view(rp.with_display(recent, "row_count_diff"), rp.RECENT_VIEW)


@query(
    "attention_tables",
    f"""WITH {_LATEST_CDC} SELECT table_name AS "Table", status AS "Status", source_row_count AS "Source", target_row_count AS "Target",
    row_count_diff AS "차이", cdc_row_count AS "이번 CDC", last_cdc_run_at AS "마지막 CDC"
    FROM latest_cdc WHERE upper(status) = 'FAILED' OR row_count_diff <> 0""",
)
def attention_tables(spark: SparkSession, sf: str) -> DataFrame:
    return rp.view(rp.attention(_latest_cdc(spark, sf)), rp.ATTENTION_VIEW)


@query(
    "distinct_statuses",
    f"WITH {i.CDC_H}, {i.FULL_H} SELECT status FROM cdc_h WHERE status IS NOT NULL UNION SELECT status FROM full_h WHERE status IS NOT NULL",
)
def distinct_statuses(spark: SparkSession, sf: str) -> DataFrame:
    return rp.options("status", i.cdc_history(spark, sf), i.full_history(spark, sf))


@query(
    "distinct_tables",
    f"WITH {i.CDC_H}, {i.FULL_H} SELECT table_name FROM cdc_h WHERE table_name IS NOT NULL UNION SELECT table_name FROM full_h WHERE table_name IS NOT NULL",
)
def distinct_tables(spark: SparkSession, sf: str) -> DataFrame:
    return rp.options("table_name", i.cdc_history(spark, sf), i.full_history(spark, sf))
