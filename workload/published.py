"""End-to-end jobs: staged files, gates, published tables, cursors.

Each run writes under a folder of its own below the cluster's shared checkpoint folder, and
returns the published table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.coerce import ntz
from tablesync.plans import backfill as bf
from tablesync.plans.files import delete_dir, is_dir, run_folder
from tablesync.plans.frames import small_frame
from tablesync.plans.full_load import load_source
from tablesync.plans.livetable import DaySlices, HashSlices, LiveTable, entries_of
from tablesync.plans.stores import ControlStore, FullLoadHistory
from tablesync.plans.sync import SyncConfig, SyncTarget, sync_many
from tablesync.sources.registry import SourceSpec
from tablesync.streaming.change_stream import apply_changes, read_changes
from workload import inputs as i
from workload.changes import _SYNCED
from workload.registry import query
from workload.scans import TABLES

SLICES = 16


def _schema_name(root: str) -> str:
    return "sync_" + root.rsplit("-", 1)[-1]


@query(
    "full_load_all",
    " UNION ALL ".join(
        f"SELECT 'lake_{t}' AS table_name, 'SUCCESS' AS status, count(*) AS pg_count, count(*) AS sf_count, "
        f"CAST(0 AS BIGINT) AS count_diff, count(*) AS extracted_count, count(*) AS staged_count FROM {t}"
        for t in TABLES
    ),
)
def full_load_all(spark: SparkSession, sf: str) -> DataFrame:
    """Full load of every table of a source; the history rows tell the counts of all sides.

    Only these rows, one per table, outlive the run: the loaded copy is dropped again.
    """
    root = run_folder(spark, "full_load")
    spec = SourceSpec("lake", "parquet", "public", _schema_name(root), {"path": sf})
    history = FullLoadHistory(spark, _schema_name(root), root)
    failed = [o for o in load_source(spark, spec, root, i.RUN_ID, history) if not o.ok]
    if failed:
        raise RuntimeError(f"{failed[0].item}: {failed[0].error}")
    records = history.read().select(
        "table_name", "status", "pg_count", "sf_count", "count_diff", "extracted_count", "staged_count"
    )
    kept = small_frame(spark, records.collect(), records.schema)
    for schema in (_schema_name(root), entries_of(_schema_name(root))):
        spark.sql(f"DROP DATABASE {schema} CASCADE")
    delete_dir(spark, root)
    return kept


def _stale_live_table(spark: SparkSession, sf: str, root: str) -> LiveTable:
    """The live table as of HI, with stale prices, sliced by key."""
    live = LiveTable(spark, f"{_schema_name(root)}.orders", f"{root}/orders", HashSlices(("o_orderkey",), SLICES))
    orders = i.table(spark, sf, "orders")
    stale = orders.filter(F.col("o_orderdate") <= ntz(i.HI)).withColumn("o_totalprice", F.col("o_totalprice") - 1)
    live.ensure(orders.schema)
    live.publish(live.write_version(stale, "initial"))
    return live


@query("cdc_sync_published", _SYNCED)
def cdc_sync_published(spark: SparkSession, sf: str) -> DataFrame:
    """Control row, bounded extract, staged files, gate, merge of the touched slices, cursor."""
    root = run_folder(spark, "sync")
    live = _stale_live_table(spark, sf, root)
    control = ControlStore(spark, _schema_name(root), root)
    control.ensure()
    cfg = SyncConfig("orders", ("o_orderkey",), "o_orderdate")
    known = [(cfg.table, cfg.cursor, ",".join(cfg.keys), "", i.LO, i.LO, cfg.source)]
    control.append(small_frame(spark, known, control.columns))
    (outcome,) = sync_many(spark, [SyncTarget(cfg, i.table(spark, sf, "orders"), live)], control, root, i.RUN_ID)
    if not outcome.ok:
        raise RuntimeError(outcome.error)
    live.expire(0)
    return live.read()


@query(
    "stream_sync",
    "SELECT * FROM orders",
)
def stream_sync(spark: SparkSession, sf: str) -> DataFrame:
    """The change file arrives as a stream and is merged into the stale live table."""
    root = run_folder(spark, "stream")
    live = _stale_live_table(spark, sf, root)
    schema, table = i.table(spark, sf, "orders").schema, f"{sf}/orders.parquet"
    if is_dir(spark, table):
        changes = read_changes(spark, table, schema)
    else:  # a stream reads folders, so a single file is picked out of its folder
        changes = read_changes(spark, sf, schema, name_pattern="orders.parquet")
    running = apply_changes(spark, changes, live, ("o_orderkey",), "o_orderdate", f"{root}/checkpoint", root)
    running.awaitTermination()
    live.expire(0)
    return live.read()


@query(
    "backfill_published",
    f"""SELECT * REPLACE (CASE WHEN ts >= {i.SQL_START} AND ts < {i.SQL_END} THEN value ELSE value + 1 END AS value) FROM events""",
)
def backfill_published(spark: SparkSession, sf: str) -> DataFrame:
    """A table sliced by day; the backfill rewrites only the days its interval touches."""
    root = run_folder(spark, "backfill")
    events = i.table(spark, sf, "events")
    live = LiveTable(spark, f"{_schema_name(root)}.events", f"{root}/events", DaySlices("ts"))
    live.ensure(events.schema)
    live.publish(live.write_version(events.withColumn("value", F.col("value") + 1), "initial"))
    bf.backfill(spark, events, "ts", live, root, i.START, i.END, i.RUN_ID)
    live.expire(0)
    return live.read()
