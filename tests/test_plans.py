"""Published tables, loads, syncs, backfills and forecasts, with failures injected."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators import merge as mg
from tablesync.operators.quality import GateFailed
from tablesync.operators.reconcile import CDC_HISTORY
from tablesync.plans import files, staging, sync
from tablesync.plans.backfill import backfill
from tablesync.plans.fanout import fan_out
from tablesync.plans.forecast import load_forecast
from tablesync.plans.frames import small_frame
from tablesync.plans.full_load import load_all, load_source, load_table
from tablesync.plans.livetable import DaySlices, HashSlices, LiveTable
from tablesync.plans.stores import CdcHistory, ControlStore, FullLoadHistory, WatermarkStore
from tablesync.plans.sync import SyncConfig, SyncTarget, configs_from, sync_many
from tablesync.sources.lake import ParquetSource
from tablesync.sources.registry import SourceSpec

SOURCE = "id long, v long, gone boolean, updated_at timestamp_ntz"
DAY = timedelta(days=1)
T0 = datetime(2024, 1, 1)


def content(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def source_frame(spark, rows):
    return small_frame(spark, rows, T.StructType.fromDDL(SOURCE))


@pytest.fixture(params=["whole", "sliced"])
def live(request, spark, tmp_path, schema_name):
    slices = HashSlices(("id",), 4) if request.param == "sliced" else None
    return LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", slices)


# -- the live table ----------------------------------------------------------------------------


def test_publish_moves_readers_to_the_new_version(spark, live):
    first = spark.range(20).select("id", F.lit(1).alias("v"))
    live.ensure(first.schema)
    assert live.read().count() == 0 and live.read().columns == ["id", "v"]
    live.publish(live.write_version(first, "a"))
    assert live.read().agg(F.sum("v")).first()[0] == 20
    path = live.write_version(first.withColumn("v", F.lit(2)).filter("id < 10"), "b")
    assert live.read().agg(F.sum("v")).first()[0] == 20  # written, not yet live
    live.publish(path)
    assert tuple(live.read().agg(F.count("*"), F.sum("v")).first()) == (10, 20)


def test_evolve_adds_columns_without_case(spark, live):
    df = spark.range(3).select("id", F.lit("x").alias("Name"))
    live.ensure(df.schema)
    live.publish(live.write_version(df, "a"))
    wider = T.StructType([*df.schema.fields, T.StructField("NAME2", T.StringType())])
    assert live.evolve(T.StructType([T.StructField("NAME", T.StringType())])) == []
    assert live.evolve(wider) == ["NAME2"]
    assert content(live.read(), "id", "NAME2") == [(0, None), (1, None), (2, None)]


def test_only_touched_slices_move(spark, tmp_path, schema_name):
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", HashSlices(("id",), 8))
    df = spark.range(100).select("id", F.lit(1).alias("v"))
    live.ensure(df.schema)
    live.publish(live.write_version(df, "a"))
    touched = list(live.slices_of(df.filter("id = 5")))
    assert len(touched) == 1
    before = live.read(touched)
    path = live.write_version(before.withColumn("v", F.lit(7)), "b")
    live.publish(path, touched)
    assert live.read().count() == 100
    assert live.read().filter("v = 7").count() == live.read(touched).count()
    scanned = live.read(touched).inputFiles()
    assert scanned and all("/v-b-" in f for f in scanned)


def test_emptied_slice_is_dropped(spark, tmp_path, schema_name):
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", HashSlices(("id",), 4))
    df = spark.range(40).select("id")
    live.ensure(df.schema)
    live.publish(live.write_version(df, "a"))
    gone = live.read([2]).count()
    live.publish(live.write_version(live.read([2]).filter("false"), "b"), [2])
    assert live.read().count() == 40 - gone


def test_expire_keeps_what_is_live(spark, live):
    df = spark.range(10).select("id")
    live.ensure(df.schema)
    for run in ("a", "b", "c"):
        live.publish(live.write_version(df, run))
    versions = lambda: [n for n in files.list_names(spark, live.root) if n.startswith("v-")]
    assert live.expire(3600) == [] and len(versions()) == 3
    live.expire(-1)
    assert len(versions()) == 1 and live.read().count() == 10


def test_expire_keeps_slices_that_were_not_replaced(spark, tmp_path, schema_name):
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", HashSlices(("id",), 4))
    df = spark.range(40).select("id")
    live.ensure(df.schema)
    live.publish(live.write_version(df, "a"))
    live.publish(live.write_version(live.read([1, 2]), "b"), [1, 2])
    assert len(live.expire(-1)) == 2
    assert live.read().count() == 40


def test_new_definition(spark, tmp_path, schema_name):
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t")
    live.ensure(spark.range(1).schema)
    other = spark.range(2).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n"))
    path = f"{tmp_path}/t/v-x"
    other.write.parquet(path)
    live.replace_definition(other.schema, path)
    assert content(live.read()) == [("0", 1), ("1", 1)]


# -- staging -----------------------------------------------------------------------------------


def test_stage_measures_what_it_writes(spark, tmp_path):
    df = source_frame(spark, [(1, 1, None, T0), (2, 2, None, T0 + DAY), (3, 3, None, None)])
    batch = staging.stage(df, df.schema, f"{tmp_path}/s", "updated_at", ["id"])
    assert (batch.rows, batch.max_cursor) == (3, T0 + DAY)
    assert batch.key_bytes > 0
    assert staging.gate(spark, batch, "t") == 3


def test_empty_extract_stays_typed(spark, tmp_path):
    df = source_frame(spark, []).filter("false")
    batch = staging.stage(df, df.schema, f"{tmp_path}/s", "updated_at", ["id"])
    assert (batch.rows, batch.max_cursor) == (0, None)
    assert batch.read(spark).schema == df.schema


def test_gate_refuses_lost_rows(spark, tmp_path):
    df = spark.range(5)
    batch = staging.stage(df, df.schema, f"{tmp_path}/s")
    short = staging.StagedBatch(batch.path, batch.schema, 6, None, 0)
    with pytest.raises(GateFailed):
        staging.gate(spark, short, "t")


def test_run_directory_goes_away_on_failure(spark, tmp_path):
    with pytest.raises(RuntimeError):
        with staging.run_directory(spark, str(tmp_path), "r", "t") as path:
            spark.range(1).write.parquet(path)
            assert files.exists(spark, path)
            raise RuntimeError
    assert not files.exists(spark, path)


# -- full load ---------------------------------------------------------------------------------


@pytest.fixture()
def lake(spark, tmp_path):
    folder = f"{tmp_path}/lake"
    spark.range(50).select("id", F.lit("x").alias("v")).write.parquet(f"{folder}/a.parquet")
    spark.range(7).select("id").write.parquet(f"{folder}/b.parquet")
    spark.range(0).select("id", F.lit(1.5).alias("d")).write.parquet(f"{folder}/empty.parquet")
    return folder


def spec_of(folder, schema, name="crm"):
    return SourceSpec(name, "parquet", "public", schema, {"path": folder})


def test_full_load_of_several_sources(spark, tmp_path, lake, schema_name):
    history = FullLoadHistory(spark, schema_name, f"{tmp_path}/h")
    specs = [spec_of(lake, schema_name), spec_of(lake, schema_name, "erp")]
    done = load_all(spark, specs, f"{tmp_path}/live", "r1", history)
    assert all(o.ok for outcomes in done.values() for o in outcomes)
    assert spark.table(f"{schema_name}.crm_a").count() == 50
    assert spark.table(f"{schema_name}.erp_empty").schema["d"].dataType == T.DoubleType()
    rows = {r["table_name"]: r for r in history.read().collect()}
    assert len(rows) == 6
    assert (rows["erp_b"]["status"], rows["erp_b"]["pg_count"], rows["erp_b"]["extracted_count"]) == ("SUCCESS", 7, 7)
    assert rows["erp_b"]["start_time"] <= rows["erp_b"]["end_time"]


class Miscounting(ParquetSource):
    """A source that reports more rows of table b than can be read."""

    def count(self, table):
        return super().count(table) + (3 if table == "b" else 0)


def test_gate_runs_before_publish(spark, tmp_path, lake, schema_name, live):
    good, bad = ParquetSource(spark, spec_of(lake, schema_name)), Miscounting(spark, spec_of(lake, schema_name))
    load_table(spark, good, "b", live, "r1")
    before = sorted(live.read().inputFiles())
    with pytest.raises(GateFailed):
        load_table(spark, bad, "b", live, "r2")
    assert sorted(live.read().inputFiles()) == before
    assert not [n for n in files.list_names(spark, live.root) if n.startswith("v-r2")]


def test_one_failing_table_is_recorded_and_the_rest_load(spark, tmp_path, lake, schema_name):
    history = FullLoadHistory(spark, schema_name, f"{tmp_path}/h")
    spec = spec_of(lake, schema_name)
    load_source(spark, spec, f"{tmp_path}/live", "r1", history, source=Miscounting(spark, spec))
    rows = {r["table_name"]: r for r in history.read().collect()}
    assert rows["crm_a"]["status"] == "SUCCESS"
    assert (rows["crm_b"]["status"], rows["crm_b"]["count_diff"]) == ("FAILED", 3)
    assert "source=10" in rows["crm_b"]["error_message"]
    assert not spark.catalog.tableExists(f"{schema_name}.crm_b")


def test_reload_with_fewer_columns(spark, tmp_path, lake, schema_name, live):
    load_table(spark, ParquetSource(spark, spec_of(lake, schema_name)), "a", live, "r1")
    spark.range(3).select("id").write.mode("overwrite").parquet(f"{lake}/a.parquet")
    load_table(spark, ParquetSource(spark, spec_of(lake, schema_name)), "a", live, "r2")
    assert live.read().columns == ["id"] and live.read().count() == 3


def test_empty_table_loads_typed(spark, lake, schema_name, live):
    load_table(spark, ParquetSource(spark, spec_of(lake, schema_name)), "empty", live, "r1")
    assert live.read().count() == 0 and live.read().columns == ["id", "d"]


def test_fan_out_isolates_failures(spark):
    def work(n):
        if n == 2:
            raise KeyError("two")
        return spark.range(n).count()

    got = fan_out(spark, [1, 2, 3], work, width=2)
    assert [(o.item, o.result, o.ok) for o in got] == [(1, 1, True), (2, None, False), (3, 3, True)]
    assert "two" in got[1].error


# -- sync --------------------------------------------------------------------------------------

CFG = SyncConfig("t", ("id",), "updated_at", "gone")
HISTORY_START = [(1, 1, None, T0), (2, 2, None, T0 + DAY), (3, 3, None, None)]
LATER = [(1, 10, False, T0 + 2 * DAY), (2, 2, True, T0 + 2 * DAY), (4, 4, None, T0 + 3 * DAY)]


@pytest.fixture()
def control(spark, tmp_path, schema_name):
    return ControlStore(spark, schema_name, f"{tmp_path}/control")


def run_sync(spark, rows, cfg, live, control, tmp_path, run_id, history=None):
    target = SyncTarget(cfg, source_frame(spark, rows), live)
    (outcome,) = sync_many(spark, [target], control, f"{tmp_path}/st", run_id, history)
    return outcome


@pytest.mark.parametrize("mode", ["bounded", "strict", "inclusive"])
def test_sync_in_steps(spark, tmp_path, schema_name, live, control, mode):
    cfg = SyncConfig("t", ("id",), "updated_at", "gone", mode)
    history = CdcHistory(spark, schema_name, f"{tmp_path}/h")
    first = run_sync(spark, HISTORY_START, cfg, live, control, tmp_path, "r1", history)
    assert first.ok and first.result.rows == 2  # the row without a cursor is never synced
    second = run_sync(spark, LATER, cfg, live, control, tmp_path, "r2", history)
    assert (second.result.rows, second.result.inserted, second.result.updated, second.result.deleted) == (3, 0, 1, 1)
    assert content(live.read(), "id", "v") == [(1, 10), (4, 4)]
    step = timedelta(microseconds=1 if mode == "inclusive" else 0)
    assert control.watermark("t") == T0 + 3 * DAY + step
    third = run_sync(spark, LATER, cfg, live, control, tmp_path, "r3", history)
    assert not third.result.changed and third.result.new_watermark == T0 + 3 * DAY + step
    assert control.read().first()["last_run_at"] is not None
    assert not files.list_names(spark, f"{tmp_path}/st/_staging/r2")
    rows = {r["dag_run_id"]: r for r in history.read().collect()}
    assert (rows["r2"]["source_row_count"], rows["r2"]["target_row_count"], rows["r2"]["status"]) == (3, 2, "MISMATCH")
    assert rows["r3"]["cdc_row_count"] == 0 and rows["r3"]["last_watermark"] == T0 + 3 * DAY + step


@pytest.mark.parametrize("kind", ["timestamp", "date"])
def test_cursor_with_zone_or_without_time(spark, tmp_path, live, control, kind):
    def rows(data):
        return source_frame(spark, data).withColumn("updated_at", F.col("updated_at").cast(kind))

    for run_id, data in (("r1", HISTORY_START), ("r2", LATER)):
        (outcome,) = sync_many(spark, [SyncTarget(CFG, rows(data), live)], control, f"{tmp_path}/st", run_id)
        assert outcome.ok, outcome.error
    assert control.watermark("t") == T0 + 3 * DAY
    assert content(live.read(), "id", "v") == [(1, 10), (4, 4)]


def test_case_of_configured_names_does_not_matter(spark, tmp_path, live, control):
    cfg = SyncConfig("T", ("ID",), "Updated_At", "GONE")
    run_sync(spark, HISTORY_START, cfg, live, control, tmp_path, "r1")
    outcome = run_sync(spark, LATER, cfg, live, control, tmp_path, "r2")
    assert outcome.ok, outcome.error
    assert (outcome.result.updated, outcome.result.deleted) == (1, 1)
    assert content(live.read(), "id", "v") == [(1, 10), (4, 4)]


def test_active_only_compares_live_rows(spark, tmp_path, schema_name, live, control):
    history = CdcHistory(spark, schema_name, f"{tmp_path}/h")
    cfg = SyncConfig("t", ("id",), "updated_at", "gone", active_only=True)
    run_sync(spark, LATER, cfg, live, control, tmp_path, "r1", history)
    assert history.read().first()["status"] == "SUCCESS"


def test_failed_gate_changes_nothing(spark, tmp_path, live, control, monkeypatch):
    run_sync(spark, HISTORY_START, CFG, live, control, tmp_path, "r1")

    def refuse(*_):
        raise GateFailed("lost rows")

    monkeypatch.setattr(sync, "gate", refuse)
    assert not run_sync(spark, LATER, CFG, live, control, tmp_path, "r2").ok
    assert content(live.read(), "id", "v") == [(1, 1), (2, 2)]
    assert control.watermark("t") == T0 + DAY


def test_failure_between_merge_and_cursor_is_replayed(spark, tmp_path, live, control, monkeypatch):
    run_sync(spark, HISTORY_START, CFG, live, control, tmp_path, "r1")
    with monkeypatch.context() as patch:
        patch.setattr(ControlStore, "advance", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_sync(spark, LATER, CFG, live, control, tmp_path, "r2")
    assert control.watermark("t") == T0 + DAY
    merged = content(live.read(), "id", "v")
    assert run_sync(spark, LATER, CFG, live, control, tmp_path, "r2").ok
    assert content(live.read(), "id", "v") == merged == [(1, 10), (4, 4)]
    assert control.watermark("t") == T0 + 3 * DAY


def test_failing_table_keeps_its_cursor(spark, tmp_path, schema_name, control):
    tables = []
    for name in ("good", "bad"):
        cfg = SyncConfig(name, ("id",), "updated_at")
        rows = HISTORY_START + ([HISTORY_START[0]] if name == "bad" else [])  # a duplicate key
        live = LiveTable(spark, f"{schema_name}.{name}", f"{tmp_path}/{name}")
        tables.append(SyncTarget(cfg, source_frame(spark, rows), live))
    outcomes = sync_many(spark, tables, control, f"{tmp_path}/st", "r1")
    assert [o.ok for o in outcomes] == [True, False]
    assert "not unique" in outcomes[1].error
    assert control.watermark("good") == T0 + DAY and control.watermark("bad") == datetime(1970, 1, 1)


def test_big_batches_go_in_groups_of_slices(spark, tmp_path, schema_name, control, monkeypatch):
    """With a tiny broadcast bound every slice is merged by itself; the result is the same."""
    monkeypatch.setattr(mg, "BROADCAST_BYTES", 200)
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", HashSlices(("id",), 4))
    many = [(n, n, None, T0) for n in range(60)]
    run_sync(spark, many, CFG, live, control, tmp_path, "r1")
    again = [(n, n * 10, n % 3 == 0, T0 + DAY) for n in range(90)]
    outcome = run_sync(spark, again, CFG, live, control, tmp_path, "r2")
    assert outcome.ok, outcome.error
    assert (outcome.result.inserted, outcome.result.updated, outcome.result.deleted) == (20, 40, 20)
    assert content(live.read(), "id", "v") == sorted(((n, n * 10) for n in range(90) if n % 3), key=repr)
    versions = [n for n in files.list_names(spark, live.root) if n.startswith("v-r2")]
    assert len(versions) == 4


def test_slice_groups():
    bound = mg.BROADCAST_BYTES
    sizes = {1: (1, bound // 2), 2: (1, bound // 3), 3: (1, 10), 4: (1, 2 * bound)}
    assert sync.slice_groups(sizes) == [([3, 2, 1], True), ([4], False)]
    assert sync.slice_groups({}) == []


def test_source_gains_a_column(spark, tmp_path, live, control):
    run_sync(spark, HISTORY_START, CFG, live, control, tmp_path, "r1")
    wider = source_frame(spark, LATER).withColumn("note", F.lit("n"))
    (outcome,) = sync_many(spark, [SyncTarget(CFG, wider, live)], control, f"{tmp_path}/st", "r2")
    assert outcome.ok
    assert content(live.read(), "id", "note") == [(1, "n"), (4, "n")]


def test_overlap_catches_late_rows(spark, tmp_path, live, control):
    run_sync(spark, HISTORY_START, CFG, live, control, tmp_path, "r1")
    late = HISTORY_START + [(8, 8, None, T0 + DAY / 2), (9, 9, None, T0 + 2 * DAY)]
    cfg = SyncConfig("t", ("id",), "updated_at", "gone", overlap=DAY)
    run_sync(spark, late, cfg, live, control, tmp_path, "r2")
    assert [r[0] for r in content(live.read(), "id")] == [1, 2, 8, 9]


def test_sync_of_a_whole_source(spark, tmp_path, schema_name, control):
    """Discovery, then sync: one table has no key, one no cursor, two qualify."""
    folder = f"{tmp_path}/lake"
    rows = source_frame(spark, HISTORY_START).withColumnRenamed("gone", "is_deleted")
    for name in ("keyless", "one"):
        rows.write.parquet(f"{folder}/{name}.parquet")
    rows.drop("is_deleted").withColumnRenamed("updated_at", "modified_at").write.parquet(f"{folder}/two.parquet")
    rows.drop("updated_at").write.parquet(f"{folder}/cursorless.parquet")
    options = {"path": folder, "keys": "one=id; two=id,v; cursorless=id"}
    spec = SourceSpec("lake", "parquet", "public", schema_name, options)
    history = CdcHistory(spark, schema_name, f"{tmp_path}/h")
    run = lambda run_id: sync.sync_source(
        spark, spec, f"{tmp_path}/live", control, run_id, history, slices=lambda c: HashSlices(c.keys, 2), mode="strict"
    )
    first = {o.result.table: o.result for o in run("r1")}
    assert {t: r.rows for t, r in first.items()} == {"lake.one": 2, "lake.two": 2}
    late = source_frame(spark, LATER).withColumnRenamed("gone", "is_deleted")
    late.write.mode("append").parquet(f"{folder}/one.parquet")
    second = {o.result.table: o.result for o in run("r2")}
    assert {t: r.rows for t, r in second.items()} == {"lake.one": 3, "lake.two": 0}
    assert content(spark.table(f"{schema_name}.one"), "id", "v") == [(1, 10), (4, 4)]
    assert history.read().count() == 4


def test_configs_from_metadata(spark):
    rows = [("t", "updated_at", ["a", "b"], None)]
    frame = spark.createDataFrame(rows, sync.ELIGIBLE)
    assert configs_from(frame, mode="strict") == [SyncConfig("t", ("a", "b"), "updated_at", None, "strict")]


def test_watermark_store(spark, tmp_path, schema_name):
    store = WatermarkStore(spark, schema_name, str(tmp_path))
    store.ensure()
    store.upsert([("a", T0)], "r1", T0 + DAY)
    store.upsert([("a", T0 + DAY), ("b", T0)], "r2", T0 + 2 * DAY)
    rows = {r["table_name"]: tuple(r)[1:] for r in store.read().collect()}
    assert rows == {"a": (T0 + DAY, "r2", T0 + 2 * DAY), "b": (T0, "r2", None)}
    tables = spark.createDataFrame([("a",), ("c",)], "table_name string")
    assert content(store.watermarks(tables)) == [("a", T0 + DAY), ("c", datetime(1970, 1, 1))]


def test_history_gains_columns(spark, tmp_path, schema_name):
    """A history made before the change counts existed gets them when it is next prepared."""
    store = CdcHistory(spark, schema_name, str(tmp_path))
    old = [f for f in CDC_HISTORY.fields if not f.name.startswith(("inserted", "updated", "deleted"))]
    store.table.ensure(T.StructType(old))
    store.ensure()
    assert set(store.read().columns) == set(CDC_HISTORY.names)


# -- backfill ----------------------------------------------------------------------------------

EVENTS = "id long, at timestamp_ntz"


@pytest.mark.parametrize("slices", [None, DaySlices("at")])
def test_backfill(spark, tmp_path, schema_name, slices):
    live = LiveTable(spark, f"{schema_name}.e", f"{tmp_path}/e", slices)
    hours = lambda n: T0 + timedelta(hours=n)
    source = spark.createDataFrame([(n, hours(n)) for n in range(0, 72, 6)], EVENTS)
    args = (f"{tmp_path}/st", hours(6), hours(30))
    assert backfill(spark, source, "at", live, *args, "r1") == 4
    assert backfill(spark, source, "at", live, *args, "r2") == 4
    assert [r[0] for r in content(live.read(), "id")] == [12, 18, 24, 6]
    backfill(spark, source, "at", live, f"{tmp_path}/st", hours(0), hours(72), "r3")
    assert live.read().count() == 12
    nothing = source.filter("false")
    assert backfill(spark, nothing, "at", live, f"{tmp_path}/st", "2024-01-02T09:00:00+09:00", "2024-01-03T09:00:00+09:00", "r4") == 0
    assert live.read().count() == 8
    assert live.read().filter("at >= '2024-01-02' and at < '2024-01-03'").count() == 0


def test_backfill_rewrites_only_its_days(spark, tmp_path, schema_name):
    live = LiveTable(spark, f"{schema_name}.e", f"{tmp_path}/e", DaySlices("at"))
    source = spark.createDataFrame([(n, T0 + n * DAY) for n in range(5)] + [(9, None)], EVENTS)
    live.ensure(source.schema)
    live.publish(live.write_version(source, "all"))
    backfill(spark, source, "at", live, f"{tmp_path}/st", T0 + DAY, T0 + 2 * DAY, "r1")
    moved = [f for f in live.read().inputFiles() if "/v-r1-" in f]
    assert len(moved) == 1 and live.read().count() == 6


# -- forecast ----------------------------------------------------------------------------------

MEASURES = ("t_max", "t_min")


def land(folder, name, daily):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps({"latitude": 1, "daily": daily}))


def test_forecast(spark, tmp_path, schema_name):
    live = LiveTable(spark, f"{schema_name}.f", f"{tmp_path}/f")
    landing = tmp_path / "landing"
    land(landing, "a", {"time": ["2024-01-01", "2024-01-02"], "t_max": [1.0, 2.0]})
    args = (str(landing), live, f"{tmp_path}/st")
    assert load_forecast(spark, *args, "r1", T0, MEASURES) == 2
    land(landing, "a", {"time": ["2024-01-02", "2024-01-03"], "t_max": [5.0, 6.0], "t_min": [0.5, None]})
    load_forecast(spark, *args, "r2", T0 + DAY, MEASURES)
    assert content(live.read(), "forecast_date", "t_max", "t_min", "loaded_at") == [
        (date(2024, 1, 1), 1.0, None, T0),
        (date(2024, 1, 2), 5.0, 0.5, T0 + DAY),
        (date(2024, 1, 3), 6.0, None, T0 + DAY),
    ]
    with pytest.raises(GateFailed, match="dated 2024-02-01"):
        load_forecast(spark, *args, "r3", datetime(2024, 2, 1), MEASURES)


@pytest.mark.parametrize(
    ("daily", "message"),
    [(None, "no daily.time"), ({"t_max": [1.0]}, "no daily.time"), ({"time": ["2024-01-01"], "t_max": [1.0, 2.0]}, "differs in length")],
)
def test_unusable_documents_are_refused(spark, tmp_path, schema_name, daily, message):
    live = LiveTable(spark, f"{schema_name}.f", f"{tmp_path}/f")
    land(tmp_path / "landing", "a", daily)
    with pytest.raises(Exception, match=message):
        load_forecast(spark, str(tmp_path / "landing"), live, f"{tmp_path}/st", "r1", T0, MEASURES)
