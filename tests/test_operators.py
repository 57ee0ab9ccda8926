"""Metadata, control, reconciliation and report operators on small frames."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablesync.operators import control as ctl
from tablesync.operators import metadata, quality
from tablesync.operators import reconcile as rc
from tablesync.operators import report as rp

T0 = datetime(2024, 1, 1)

COLUMNS = [
    ("public", "both", "modified_at", 1),
    ("public", "both", "updated_at", 2),
    ("public", "both", "deleted", 3),
    ("public", "both", "is_deleted", 4),
    ("public", "second", "last_modified", 1),
    ("public", "second", "id", 2),
    ("public", "nokey", "updated_at", 1),
    ("public", "nocursor", "id", 1),
    ("other", "nocursor", "updated_at", 1),
]
CONSTRAINTS = [
    ("public", "both", "pk_both", "PRIMARY KEY"),
    ("public", "both", "uq_both", "UNIQUE"),
    ("public", "second", "pk_second", "PRIMARY KEY"),
    ("public", "nocursor", "pk_nocursor", "PRIMARY KEY"),
    ("other", "nocursor", "pk_nocursor", "PRIMARY KEY"),
]
USAGE = [
    ("public", "pk_both", "b_second", 2),
    ("public", "pk_both", "z_first", 1),
    ("public", "uq_both", "deleted", 1),
    ("public", "pk_second", "id", 1),
    ("public", "pk_nocursor", "id", 1),
    ("other", "pk_nocursor", "updated_at", 1),
]


@pytest.fixture()
def meta(spark):
    columns = spark.createDataFrame(
        [(*c, "text") for c in COLUMNS], "table_schema string, table_name string, column_name string, ordinal_position int, data_type string"
    )
    constraints = spark.createDataFrame(
        CONSTRAINTS, "table_schema string, table_name string, constraint_name string, constraint_type string"
    )
    usage = spark.createDataFrame(USAGE, "table_schema string, constraint_name string, column_name string, ordinal_position int")
    return columns, constraints, usage


def test_eligibility(meta):
    found = {r["table_name"]: r for r in metadata.cdc_eligible(*meta, "public").collect()}
    assert set(found) == {"both", "second"}
    assert (found["both"]["updated_at_col"], found["both"]["delete_flag_col"]) == ("updated_at", "is_deleted")
    assert found["both"]["pk_columns"] == ["z_first", "b_second"]  # by key position, none lost
    assert (found["second"]["updated_at_col"], found["second"]["delete_flag_col"]) == ("last_modified", None)


def test_columns_are_schema_qualified(meta):
    rows = metadata.table_columns(meta[0], "public").filter("table_name = 'nocursor'").collect()
    assert [r["column_name"] for r in rows] == ["id"]


def test_control_cycle(spark):
    eligible = spark.createDataFrame(
        [("a", "updated_at", ["x", "y"], None), ("b", "updated_at", ["id"], "deleted")],
        "table_name string, updated_at_col string, pk_columns array<string>, delete_flag_col string",
    )
    empty = spark.createDataFrame([], ctl.CONTROL_SCHEMA)
    control = ctl.init_control(empty, eligible)
    rows = {r["table_name"]: r for r in control.collect()}
    assert (rows["a"]["pk_columns"], rows["a"]["delete_flag_col"], rows["a"]["last_run_at"]) == ("x,y", "", None)
    assert ctl.init_control(control, eligible).count() == 2
    results = spark.createDataFrame([("b", T0), ("stranger", T0)], "table_name string, new_watermark timestamp_ntz")
    after = {r["table_name"]: r for r in ctl.advance(control, results, T0).collect()}
    assert set(after) == {"a", "b"}
    assert (after["b"]["last_watermark"], after["b"]["last_run_at"], after["b"]["delete_flag_col"]) == (T0, T0, "deleted")
    assert after["a"]["last_watermark"] == datetime(1970, 1, 1)


def test_lookup_folds_case(spark):
    tables = spark.createDataFrame([("orders",), ("new",)], "table_name string")
    stored = spark.createDataFrame([("ORDERS", T0)], "table_name string, last_watermark timestamp_ntz")
    got = {r["table_name"]: r["watermark"] for r in ctl.lookup_watermarks(tables, stored).collect()}
    assert got == {"orders": T0, "new": datetime(1970, 1, 1)}


def test_reconcile_both_directions(spark):
    source = spark.createDataFrame([("a", 5), ("b", 2)], "table_name string, row_count long")
    target = spark.createDataFrame([("a", 5), ("c", 1)], "table_name string, row_count long")
    got = {r["table_name"]: (r["count_diff"], r["status"]) for r in rc.reconcile_counts(source, target, "FAILED").collect()}
    assert got == {"a": (0, "SUCCESS"), "b": (2, "FAILED"), "c": (-1, "FAILED")}


RUNS = [  # run, table, time, status, diff
    ("r1", "a", datetime(2024, 1, 1), "SUCCESS", 0),
    ("r2", "a", datetime(2024, 1, 2), "FAILED", 3),
    ("r3", "b", datetime(2024, 1, 1), "success", 0),
    ("r4", "b", None, "FAILED", 0),
    ("r5", None, datetime(2024, 1, 1), "SUCCESS", 1),
    ("r6", None, datetime(2024, 1, 3), None, None),
    ("r8", "c", datetime(2024, 1, 1), "SUCCESS", 0),
    ("r7", "c", datetime(2024, 1, 1), "SUCCESS", 2),
]


@pytest.fixture()
def runs(spark):
    return spark.createDataFrame(
        [(*r, 10) for r in RUNS],
        "dag_run_id string, table_name string, checked_at timestamp_ntz, status string, row_count_diff long, cdc_row_count long",
    )


def latest_ids(df):
    return sorted(r["dag_run_id"] for r in rp.latest_per_table(df, "checked_at", "dag_run_id").collect())


def test_latest_per_table(runs):
    assert latest_ids(runs) == ["r2", "r3", "r6", "r7"]  # no time last, no name one group, tie by run


def test_filters_come_before_latest(runs):
    assert latest_ids(rp.filtered(runs, rp.CDC, status="Success")) == ["r1", "r3", "r5", "r7"]
    assert latest_ids(rp.filtered(runs, rp.CDC, table="a")) == ["r2"]
    none = rp.filtered(runs, rp.CDC, selected=rp.FULL_LOAD)
    assert none.count() == 0 and none.columns == runs.columns


def test_kpis_count_a_failed_difference_twice(runs):
    latest = rp.latest_per_table(runs, "checked_at", "dag_run_id")
    row = rp.cdc_kpis(latest).first()
    assert (row["table_count"], row["ok_count"], row["failed_count"], row["mismatch_count"]) == (4, 1, 1, 2)
    assert (row["mismatch_plus_failed"], row["problem_tables"]) == (3, 2)
    full = rp.full_kpis(latest.withColumnRenamed("row_count_diff", "count_diff")).first()
    assert full["ok_count"] == 2  # status alone


def test_attention_and_options(runs):
    latest = rp.latest_per_table(runs, "checked_at", "dag_run_id")
    assert sorted(r["dag_run_id"] for r in rp.attention(latest).collect()) == ["r2", "r7"]
    assert [r[0] for r in rp.options("table_name", runs, runs).collect()] == ["a", "b", "c"]


def test_today_changes(runs):
    assert rp.today_changes(runs, datetime(2024, 1, 2, 18)).first()[0] == 20
    assert rp.today_changes(runs, datetime(2025, 1, 1)).first()[0] == 0


def test_dq_summary_all_clear(spark, runs):
    clear = runs.filter("dag_run_id in ('r1', 'r3')")
    full = clear.withColumnRenamed("row_count_diff", "count_diff")
    assert rp.dq_summary(clear, full).first()["all_clear"] is True
    assert rp.dq_summary(runs, full).first()["all_clear"] is False
    empty = rp.dq_summary(clear.filter("false"), full.filter("false")).first()
    assert (empty["cdc_mismatch"], empty["all_clear"]) == (0, True)


def test_recent_activity_is_top_k(runs):
    recent = rp.recent_activity(runs, "dag_run_id", rows=2)
    assert [r["dag_run_id"] for r in recent.collect()] == ["r6", "r2"]
    assert "TakeOrderedAndProject" in recent._jdf.queryExecution().executedPlan().toString()


def test_view_takes_what_is_there(runs):
    shown = rp.view(rp.normalize_columns(runs), rp.CDC_VIEW)
    assert shown.columns == ["Table", "차이", "이번 CDC"]


def test_coerce_counts(spark):
    df = spark.createDataFrame([("7", None), ("n/a", 2)], "pg_count string, sf_count long")
    assert [tuple(r) for r in rp.coerce_counts(df, rp.FULL_COUNTS).collect()] == [(7.0, 0), (0.0, 2)]


def test_quality(spark):
    days = spark.sql("SELECT DATE'2024-01-01' AS d UNION ALL SELECT DATE'2024-01-03'")
    assert quality.freshness(days, "d", T0.date().replace(day=3)).first()["is_fresh"] is True
    assert quality.freshness(days, "d", T0.date().replace(day=4)).first()["is_fresh"] is False
    assert quality.batch_profile(days, "d").first()["row_count"] == 2
    with pytest.raises(quality.GateFailed):
        quality.require_equal("t", 1, 2)
    counts = lambda n: spark.range(1).select(F.lit(n).cast("long").alias("row_count"))
    assert quality.count_gate(counts(3), counts(3)).first()["gate_ok"] is True
    assert quality.count_gate(counts(3), counts(2)).first()["gate_ok"] is False


def test_hot_table_is_limited_before_the_shuffle(spark, runs, tmp_path):
    runs.write.parquet(f"{tmp_path}/h")
    latest = rp.latest_per_table(spark.read.parquet(f"{tmp_path}/h"), "checked_at", "dag_run_id")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("row_number(), 1, Partial")
