"""What must not lose rows: stored layouts, cursor names, quiet tables, late changes, failures on record."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tablesync.operators import control as ctl
from tablesync.operators.metadata import change_columns
from tablesync.plans import full_load, sync
from tablesync.plans.fanout import Outcome, raise_failed
from tablesync.plans.livetable import HashSlices, LiveTable
from tablesync.plans.stores import CdcHistory, ControlStore, FullLoadHistory
from tablesync.plans.sync import SyncConfig, SyncTarget
from tablesync.sources.jdbc import range_options, splits_by_range
from tablesync.sources.registry import SourceSpec, open_source
from tablesync.streaming.change_stream import without_stale

T0 = datetime(2024, 1, 1)


def test_a_table_keeps_the_layout_it_was_created_with(spark, tmp_path, schema_name):
    first = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", HashSlices(("id",), 8))
    rows = spark.range(1500).selectExpr("id", "id AS v")
    first.ensure(rows.schema)
    first.publish(first.write_version(rows, "r:1"))
    for given in (HashSlices(("id",), 16), None):
        again = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", given)
        assert again.slices == HashSlices(("id",), 8)
        batch = spark.range(0, 1500, 50).selectExpr("id", "-1L AS v")
        touched = list(again.slices_of(batch))
        merged = again.read(touched).where("id % 50 <> 0").unionByName(batch)
        again.publish(again.write_version(merged, "r2"), touched)
        assert again.read().count() == 1500 and again.read().select("id").distinct().count() == 1500


def test_few_files_for_each_slice(spark, tmp_path, schema_name):
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", HashSlices(("id",), 16))
    rows = spark.range(1500).repartition(16)
    live.ensure(rows.schema)
    path = live.write_version(rows, "r1")
    assert len(spark.read.parquet(path).inputFiles()) <= 32


def test_cursors_are_kept_by_source_and_without_case(spark):
    stored = spark.createDataFrame([("ORDERS", "u", "id", "", T0, T0)], ctl.CONTROL_SCHEMA)
    eligible = spark.createDataFrame([("orders", "u", ["id"], None), ("crm.orders", "u", ["id"], None)], sync.ELIGIBLE)
    after = ctl.init_control(stored, eligible)
    assert sorted(r.table_name for r in after.collect()) == ["ORDERS", "crm.orders"]
    moved = ctl.advance(after, spark.createDataFrame([("Orders", T0 + timedelta(days=1))], "table_name string, new_watermark timestamp_ntz"), T0)
    found = {r.table_name: r.watermark for r in ctl.lookup_watermarks(eligible, moved).collect()}
    assert found == {"orders": T0 + timedelta(days=1), "crm.orders": datetime(1970, 1, 1)}
    assert SyncConfig("Orders", ("id",), "u", source="CRM").control_name == "crm.orders"


def test_late_rows_of_a_quiet_table_are_read(spark, tmp_path, schema_name):
    rows = spark.createDataFrame([(1, T0), (2, T0 - timedelta(hours=1))], "id long, at timestamp_ntz")
    live = LiveTable(spark, f"{schema_name}.q", f"{tmp_path}/q")
    cfg = SyncConfig("q", ("id",), "at", overlap=timedelta(days=1))
    result = sync.sync_table(spark, rows, cfg, live, T0, str(tmp_path), "r")
    assert result.rows == 2 and result.new_watermark == T0 and live.read().count() == 2


def test_older_changes_do_not_replace_newer_rows(spark):
    target = spark.createDataFrame([(1, "new", T0), (2, "old", T0)], "id long, v string, at timestamp_ntz")
    batch = spark.createDataFrame([(1, "stale", T0 - timedelta(days=1)), (2, "newer", T0 + timedelta(days=1)), (3, "own", T0)], target.schema)
    assert sorted(r.v for r in without_stale(batch, target, ["ID"], "AT").collect()) == ["newer", "own"]


def test_eligibility_does_not_depend_on_case(spark):
    columns = spark.createDataFrame([("S", "T", "UPDATED_AT"), ("S", "T", "Is_Deleted"), ("S", "U", "X")], "table_schema string, table_name string, column_name string")
    got = {r.table_name: (r.updated_at_col, r.delete_flag_col) for r in change_columns(columns, "S").collect()}
    assert got == {"T": ("UPDATED_AT", "Is_Deleted"), "U": (None, None)}


def test_split_bounds(spark):
    assert range_options('"k"', Decimal("1.0000000000"), Decimal("9"), 2)["lowerBound"] == "1"
    assert not splits_by_range(T.DecimalType(38, 10)) and not splits_by_range(T.DoubleType()) and splits_by_range(T.DecimalType(18, 0))
    for kind, mark in (("postgres", '"'), ("mysql", "`"), ("oracle", '"')):
        source = open_source(spark, SourceSpec("s", kind, "S", "x", {"url": "jdbc:none"}))
        table = f"{mark}S{mark}.{mark}t{mark}"
        assert source.count_sql("t") == f"SELECT COUNT(*) AS n FROM {table}"
        assert source.bounds_sql("t", "k") == f"SELECT MIN({mark}k{mark}) AS low, MAX({mark}k{mark}) AS high FROM {table}"
        assert source.newest_sql("t", "u", T0) == f"SELECT MAX({mark}u{mark}) AS upper_watermark FROM {table} WHERE {mark}u{mark} > TIMESTAMP '2024-01-01 00:00:00.000000'"


def test_failures_are_on_record(spark, tmp_path, schema_name):
    history = FullLoadHistory(spark, schema_name, f"{tmp_path}/h")
    spark.range(3).write.parquet(f"{tmp_path}/lake/a.parquet")
    good = SourceSpec("good", "parquet", "p", schema_name, {"path": f"{tmp_path}/lake"})
    bad = SourceSpec("bad", "nothing", "p", schema_name)
    outcomes = full_load.load_all(spark, [bad, good], f"{tmp_path}/live", "r1", history)
    assert [o.ok for o in outcomes["bad"]] == [False] and [o.ok for o in outcomes["good"]] == [True]
    assert {(r.table_name, r.status) for r in history.read().collect()} == {("bad", "FAILED"), ("good_a", "SUCCESS")}
    with pytest.raises(RuntimeError, match="unknown source kind"):
        raise_failed(outcomes["bad"])


def test_a_table_that_cannot_be_synced_is_on_record(spark, tmp_path, schema_name):
    control, history = ControlStore(spark, schema_name, f"{tmp_path}/c"), CdcHistory(spark, schema_name, f"{tmp_path}/h")

    def broken():
        raise OSError("no connection")

    target = SyncTarget(SyncConfig("t", ("id",), "at"), broken, LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t"))
    outcomes = sync.sync_many(spark, [target], control, str(tmp_path), "r1", history)
    assert [o.ok for o in outcomes] == [False]
    assert [(r.table_name, r.status) for r in history.read().collect()] == [("t", "FAILED")]
    assert Outcome("x", 1, None).ok
