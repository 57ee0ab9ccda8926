"""What must not grow with a batch or a history: bytes sent through the driver, and the share of one task."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tablesync.operators import merge as mg
from tablesync.plans import sync
from tablesync.plans.livetable import HashSlices, LiveTable
from tablesync.plans.staging import stage
from tablesync.plans.stores import CdcHistory

T0 = datetime(2024, 1, 1)


def test_latest_runs_are_written_by_many_tasks(spark, tmp_path, schema_name):
    history = CdcHistory(spark, schema_name, str(tmp_path))
    runs = spark.range(4000).select(
        F.concat(F.lit("r"), "id").alias("dag_run_id"),
        F.concat(F.lit("t"), F.col("id") % 1000).alias("table_name"),
        (F.lit(T0).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id)")).alias("checked_at"),
        F.lit("SUCCESS").alias("status"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        history.load(runs)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    latest = history.latest()
    assert len(latest.inputFiles()) > 1
    assert sorted(r.dag_run_id for r in latest.collect()) == sorted(f"r{n}" for n in range(3000, 4000))


def test_one_group_of_a_batch_is_broadcast():
    bound = mg.BROADCAST_BYTES
    groups = sync.slice_groups({k: (1, bound // 3) for k in range(16)} | {16: (1, 2 * bound)})
    assert sorted(s for slices, _ in groups for s in slices) == list(range(17))
    assert [small for _, small in groups] == [True] + [False] * (len(groups) - 1) and len(groups) > 2


def test_broadcast_and_shuffled_groups_of_a_batch(spark, tmp_path, schema_name, monkeypatch):
    """Keys deleted, changed, added and older than the table's, with a bound that some of eight slices fit."""
    kinds, written, plain = "id long, v long, gone boolean, at timestamp_ntz", [], sync._write_group
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t", HashSlices(("id",), 8))
    held = spark.createDataFrame([(n, n, None, T0 + timedelta(days=n % 2)) for n in range(400)], kinds)
    live.ensure(held.schema)
    live.publish(live.write_version(held, "r1"))
    monkeypatch.setattr(mg, "BROADCAST_BYTES", 12_000)

    def seen(spark, live, batch, spec, touched, *more):
        written.append((spec.broadcast_keys, len(touched)))
        return plain(spark, live, batch, spec, touched, *more)

    monkeypatch.setattr(sync, "_write_group", seen)
    rows = spark.createDataFrame([(n, -n, n % 5 == 0, T0 + timedelta(days=n % 3 / 2)) for n in range(200, 600)], kinds)
    batch = stage(rows, rows.schema, f"{tmp_path}/st", "at", ["id"], live.slices)
    counts = sync.merge_batch(spark, live, batch, ["id"], "gone", "r2", "at", unique=True)
    assert [small for small, _ in sorted(written, reverse=True)] == [True] + [False] * (len(written) - 1) and len(written) > 2
    applied = {n for n in range(200, 600) if n >= 400 or n % 2 <= n % 3 / 2}
    want = {n: -n if n in applied else n for n in range(600) if n < 400 or n in applied}
    gone = {n for n in applied if n % 5 == 0}
    assert {r.id: r.v for r in live.read().collect()} == {n: v for n, v in want.items() if n not in gone}
    assert counts == (len([n for n in applied - gone if n >= 400]), len([n for n in applied - gone if n < 400]), len([n for n in gone if n < 400]))
