"""Stream of change files against the batch result."""

from __future__ import annotations

from datetime import datetime, timedelta

from tablesync.operators.merge import MergeSpec, latest_per_merge_key, merge
from tablesync.plans.livetable import LiveTable
from tablesync.streaming.change_stream import apply_changes, read_changes

SCHEMA = "id long, v long, gone boolean, updated_at timestamp_ntz"
T0 = datetime(2024, 1, 1)


def test_two_starts_over_a_growing_folder(spark, tmp_path, schema_name):
    folder = f"{tmp_path}/in"
    batches = [
        [(1, 1, None, T0), (1, 2, None, T0 + timedelta(hours=1)), (2, 1, None, T0)],
        [(2, 5, True, T0 + timedelta(days=1)), (3, 3, False, T0 + timedelta(days=1))],
    ]
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t")
    expected = None
    for number, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(folder)
        changes = read_changes(spark, folder, frame.schema, max_files=1)
        apply_changes(spark, changes, live, ["id"], "updated_at", f"{tmp_path}/cp", f"{tmp_path}/st", "gone").awaitTermination()
        newest = latest_per_merge_key(frame, ["id"], "updated_at")
        expected = merge(frame.filter("false") if expected is None else expected, newest, MergeSpec(("id",), "gone"))
        got = sorted((r["id"], r["v"]) for r in live.read().collect())
        assert got == sorted((r["id"], r["v"]) for r in expected.collect())
    assert got == [(1, 2), (3, 3)]
    before = sorted(live.read().inputFiles())
    changes = read_changes(spark, folder, frame.schema)
    apply_changes(spark, changes, live, ["id"], "updated_at", f"{tmp_path}/cp", f"{tmp_path}/st", "gone").awaitTermination()
    assert sorted(live.read().inputFiles()) == before  # nothing new, nothing rewritten
