"""One move per batch, whatever its size; what is left after failures; plans of the merge."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators import merge as mg
from tablesync.operators.reconcile import CDC_HISTORY
from tablesync.plans import files, livetable, sync
from tablesync.plans.backfill import backfill
from tablesync.plans.frames import rows_frame
from tablesync.plans.livetable import DaySlices, HashSlices, LiveTable
from tablesync.plans.stores import CdcHistory, ControlStore
from tablesync.streaming.change_stream import apply_changes, deleted_keys, read_changes

T0 = datetime(2024, 1, 1)
DAY = timedelta(days=1)
CHANGES = "id long, v long, gone boolean, at timestamp_ntz"


def content(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


@pytest.fixture()
def shuffled(spark):
    """Plans as they are for sides that cannot be broadcast."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_merge_shuffles_either_side_once(spark, shuffled):
    target = spark.range(100).selectExpr("id", "id AS v", "'t' AS only_target", "CAST(NULL AS boolean) AS gone")
    staged = spark.range(50, 150).selectExpr("id", "-id AS v", "id % 3 = 0 AS gone", "'s' AS only_staged")
    spec = mg.MergeSpec(("id",), "gone")
    merged, counts = mg.merge(target, staged, spec), mg.change_counts(target, staged, spec)
    for plan in (plan_of(merged), plan_of(counts)):
        assert plan.count("Exchange hashpartitioning") <= 2 and plan.count("Join") == 1, plan
    assert "SortMergeJoin" in plan_of(merged) and "FullOuter" in plan_of(merged)


@pytest.mark.parametrize("cursor", [None, "at"])
def test_both_ways_of_merging_agree(spark, cursor):
    at = "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id % 5)"
    target = spark.range(60).selectExpr("id", "id AS v", "'t' AS only_target", "false AS gone", f"{at} AS at").unionByName(
        spark.sql("SELECT CAST(NULL AS bigint) AS id, 7L AS v, 't' AS only_target, false AS gone, timestamp_ntz'2024-01-01' AS at")
    )
    staged = spark.range(30, 90).selectExpr("id", "-id AS v", "CASE id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS gone", "'s' AS more", "timestamp_ntz'2024-01-03' AS at").unionByName(
        spark.sql("SELECT CAST(NULL AS bigint) AS id, 8L AS v, false AS gone, 's' AS more, timestamp_ntz'2024-01-01' AS at")
    )
    found = []
    for broadcast in (False, True):
        spec = mg.MergeSpec(("id",), "gone", broadcast, cursor)
        rows = mg.merged_rows(target, mg.align(staged, target), spec)
        counts = rows.agg(*mg.count_columns(rows, "gone")).first()
        found.append((content(mg.merge(target, staged, spec)), tuple(counts)))
    assert found[0] == found[1] and len(found[0][0]) > 60
    if cursor:
        assert any(r[0] == 34 and r[1] == 34 for r in found[0][0])  # the target's row of the fifth is newer


class Refused(Exception):
    pass


@pytest.mark.parametrize("stage", ["_new_entry", "_write_manifest", "_move", "register"])
def test_a_publish_cut_short_publishes_nothing(spark, tmp_path, schema_name, monkeypatch, stage):
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", HashSlices(("id",), 8))
    rows = spark.range(100).selectExpr("id", "1 AS v")
    live.ensure(rows.schema)
    live.publish(live.write_version(rows, "a"))
    path = live.write_version(rows.withColumn("v", F.lit(2)), "b")
    with monkeypatch.context() as patch:
        if stage == "register":
            plain = spark.sql
            patch.setattr(livetable, "REGISTERED_AT_ONCE", 3)
            calls = []

            def fails(text, *args, **kwargs):
                if " ADD PARTITION" in text:
                    calls.append(text)
                    if len(calls) == 2:
                        raise Refused
                return plain(text, *args, **kwargs)

            patch.setattr(spark, "sql", fails)
        else:
            patch.setattr(LiveTable, stage, lambda *_: (_ for _ in ()).throw(Refused))
        with pytest.raises(Refused):
            live.publish(path)
    assert content(live.read().groupBy("v").count()) == [(1, 100)]
    assert live.expire(-1) == [] and live.read().count() == 100  # leftovers go, what is live stays
    assert len(live._entries()) == 1 and len([n for n in files.list_names(spark, live.root) if n.startswith("v-")]) == 1
    live.publish(live.write_version(rows.withColumn("v", F.lit(3)), "c"))
    assert content(live.read().groupBy("v").count()) == [(3, 100)]


def test_a_failed_group_publishes_nothing(spark, tmp_path, schema_name, monkeypatch):
    monkeypatch.setattr(mg, "BROADCAST_BYTES", 200)
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", HashSlices(("id",), 4))
    rows = spark.range(60).selectExpr("id", "id AS v", "false AS gone", "timestamp_ntz'2024-01-01' AS updated_at")
    control = ControlStore(spark, schema_name, f"{tmp_path}/c")
    cfg = sync.SyncConfig("t", ("id",), "updated_at", "gone")
    run = lambda df, run_id: sync.sync_many(spark, [sync.SyncTarget(cfg, df, live)], control, f"{tmp_path}/st", run_id)[0]
    assert run(rows, "r1").ok
    later = rows.selectExpr("id", "-v AS v", "gone", "timestamp_ntz'2024-01-02' AS updated_at")
    written, plain = [], LiveTable.write_version

    def third_fails(self, *args, **kwargs):
        if self.name == live.name:
            written.append(1)
            if len(written) == 3:
                raise Refused
        return plain(self, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(LiveTable, "write_version", third_fails)
        assert not run(later, "r2").ok
    assert live.read().where("v < 0").count() == 0
    assert not [n for n in files.list_names(spark, live.root) if n.startswith("v-r2")]
    done = run(later, "r2")
    assert done.ok and done.result.updated == 60 and live.read().where("v < 0").count() == 59


def test_catalog_calls_do_not_grow_with_slices(spark, tmp_path, schema_name, monkeypatch):
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", HashSlices(("id",), 512))
    rows = spark.range(4000)
    live.ensure(rows.schema)
    live.publish(live.write_version(rows, "a"))
    path, plain, calls = live.write_version(rows, "b"), spark.sql, []
    monkeypatch.setattr(spark, "sql", lambda text, *a, **k: calls.append(text) or plain(text, *a, **k))
    live.publish(path)
    moves = [c for c in calls if not c.startswith("SHOW")]
    assert [c.split()[0] for c in moves] == ["CREATE", "ALTER", "CREATE"]
    calls.clear()
    assert len(live.expire(-1)) > 400 and len([c for c in calls if not c.startswith("SHOW")]) <= 4
    assert live.read().count() == 4000


def test_another_definition_needs_no_drop(spark, tmp_path, schema_name, monkeypatch):
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t")
    first = spark.range(3).selectExpr("id", "'x' AS name")
    live.ensure(first.schema)
    live.publish(live.write_version(first, "a"))
    path, plain, calls = live.version_path("b"), spark.sql, []
    spark.range(2).selectExpr("CAST(id AS string) AS id", "1.5 AS n").write.parquet(path)
    monkeypatch.setattr(spark, "sql", lambda text, *a, **k: calls.append(text) or plain(text, *a, **k))
    live.replace_definition(T.StructType.fromDDL("id string, n decimal(2,1)"), path)
    assert not [c for c in calls if "DROP" in c or "RENAME" in c]
    assert [r.id for r in live.read().orderBy("id").collect()] == ["0", "1"] and live.read().columns == ["id", "n"]


def test_histories_keep_few_files(spark, tmp_path, schema_name, monkeypatch):
    history = CdcHistory(spark, schema_name, f"{tmp_path}/h")
    history.ensure()
    for run in range(12):
        at = T0 + timedelta(hours=6 * run)
        rows = [{"dag_run_id": f"r{run}", "table_name": f"t{k}", "checked_at": at, "status": "SUCCESS"} for k in range(3)]
        history.append(rows_frame(spark, rows, CDC_HISTORY))
    assert history.read().count() == 36 and len(history.read().inputFiles()) <= 6
    history.table.expire(-1)
    names = [n for n in files.list_names(spark, history.table.root) if n.startswith("v-")]
    assert history.read().count() == 36 and len(names) <= 3


def test_every_job_expires(spark, tmp_path, schema_name):
    source = spark.createDataFrame([(n, T0 + n * DAY / 4) for n in range(12)], "id long, at timestamp_ntz")
    live = LiveTable(spark, f"{schema_name}.b", f"{tmp_path}/b", DaySlices("at"))
    for run in range(3):
        backfill(spark, source, "at", live, f"{tmp_path}/st", T0, T0 + 2 * DAY, f"r{run}", retention=-1)
    assert len([n for n in files.list_names(spark, live.root) if n.startswith("v-")]) == 1 and live.read().count() == 8
    folder = f"{tmp_path}/in"
    stream = LiveTable(spark, f"{schema_name}.s", f"{tmp_path}/s")
    for run in range(3):
        changes = spark.createDataFrame([(1, run, run == 2, T0 + run * DAY)], CHANGES)
        changes.coalesce(1).write.mode("append").parquet(folder)
        started = apply_changes(spark, read_changes(spark, folder, changes.schema), stream, ["id"], "at", f"{tmp_path}/cp", f"{tmp_path}/st", "gone", retention=-1)
        started.awaitTermination()
    assert len([n for n in files.list_names(spark, stream.root) if n.startswith("v-")]) == 1
    assert content(deleted_keys(stream).read()) == [(1, T0 + 2 * DAY)]


@pytest.mark.parametrize("slices", [None, HashSlices(("id",), 4)])
def test_late_changes_of_deleted_keys(spark, tmp_path, schema_name, slices):
    live = LiveTable(spark, f"{schema_name}.s", f"{tmp_path}/s", slices)
    batches = [
        [(1, 1, False, T0), (2, 1, False, T0), (3, 1, None, T0)],
        [(1, 1, True, T0 + 2 * DAY), (2, 1, True, T0 + 2 * DAY), (9, 1, True, T0 + 2 * DAY)],
        [(1, 5, False, T0 + DAY), (2, 6, False, T0 + 3 * DAY), (3, 7, None, T0 - DAY), (9, 9, False, T0 + DAY)],
        [(2, 8, False, T0 + DAY), (1, 9, True, T0 + DAY)],
    ]
    for rows in batches:
        frame = spark.createDataFrame(rows, CHANGES)
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        changes = read_changes(spark, f"{tmp_path}/in", frame.schema)
        apply_changes(spark, changes, live, ["ID"], "AT", f"{tmp_path}/cp", f"{tmp_path}/st", "Gone").awaitTermination()
    assert content(live.read(), "id", "v") == [(2, 6), (3, 1)]


def test_markers_of_deletes_are_forgotten(spark, tmp_path, schema_name):
    live = LiveTable(spark, f"{schema_name}.s", f"{tmp_path}/s")
    for rows in ([(1, 1, True, T0)], [(2, 1, True, T0 + 40 * DAY)]):
        frame = spark.createDataFrame(rows, CHANGES)
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        changes = read_changes(spark, f"{tmp_path}/in", frame.schema)
        apply_changes(spark, changes, live, ["id"], "at", f"{tmp_path}/cp", f"{tmp_path}/st", "gone", remember=30 * DAY).awaitTermination()
    assert content(deleted_keys(live).read(), "id") == [(2,)]


def test_live_tables_are_a_source(spark, tmp_path, schema_name):
    from tablesync.sources.registry import SourceSpec, open_source

    live = LiveTable(spark, f"{schema_name}.Orders__old", f"{tmp_path}/t", HashSlices(("id",), 4))
    live.ensure(spark.range(1).schema)
    live.publish(live.write_version(spark.range(9), "a"))
    spark.sql(f"CREATE VIEW {schema_name}.other AS SELECT 1 AS x")
    source = open_source(spark, SourceSpec("s", "catalog", schema_name, "x"))
    assert [t.lower() for t in source.tables()] == ["orders__old"] and source.count("Orders__old") == 9
    live.drop()
    assert source.tables() == []


def test_months_are_slices(spark, tmp_path, schema_name):
    layout = livetable.MonthSlices("at")
    assert livetable.layout_of(livetable.layout_text(layout)) == layout
    assert livetable.layout_of(livetable.layout_text(DaySlices("at"))) == DaySlices("at")
    live = LiveTable(spark, f"{schema_name}.m", f"{tmp_path}/m", layout)
    rows = spark.createDataFrame([(k, T0 + k * 10 * DAY) for k in range(8)] + [(9, None)], "id long, at timestamp_ntz")
    live.ensure(rows.schema)
    live.publish(live.write_version(rows, "a"))
    assert sorted(live.manifest().live) == ["0001-01-01", "2024-01-01", "2024-02-01", "2024-03-01"]
    assert sorted(live.manifest().live) == sorted({str(layout.day(r.at)) for r in rows.collect()})
    assert live.read([layout.day(T0)]).count() == 4
