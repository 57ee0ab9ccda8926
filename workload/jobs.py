"""Jobs on stores: cursors of several sources, late changes of a stream, rows without a cursor, the report.

Each run writes under a folder of its own below the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import re
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.coerce import ntz
from tablesync.functions.typemap import spark_type, typed
from tablesync.operators import control as ctl
from tablesync.operators.extract import STRICT, extract_changes, extract_interval
from tablesync.operators.interval import interval_count, replace_interval
from tablesync.operators.quality import count_gate
from tablesync.plans.files import delete_dir, run_folder
from tablesync.plans.frames import small_frame
from tablesync.plans.full_load import load_source
from tablesync.plans.livetable import HashSlices, LiveTable
from tablesync.plans.report import report
from tablesync.plans.staging import run_directory, stage
from tablesync.plans.stores import CdcHistory, ControlStore, FullLoadHistory, WatermarkStore
from tablesync.plans.sync import SyncConfig, SyncTarget, sync_many
from tablesync.sources.lake import ParquetSource
from tablesync.sources.registry import SourceSpec
from tablesync.streaming.change_stream import apply_changes, read_changes
from workload import inputs as i
from workload.published import _schema_name, _stale_live_table
from workload.registry import query
from workload.scans import TABLES

DAY = timedelta(days=1)


@query(
    "watermark_advance_clash",
    f"""WITH {i.ELIGIBLE}, {i.CONTROL}, {i.BATCHES}, c AS (
      SELECT 'crm' AS source_name, table_name, * EXCLUDE (table_name) FROM control
      UNION ALL SELECT 'crm', upper(table_name), * EXCLUDE (table_name) FROM control
      UNION ALL SELECT '', 'crm.' || table_name, * EXCLUDE (table_name) FROM control),
    r AS (
      SELECT 'crm' AS source_name, table_name, new_watermark FROM batches
      UNION ALL SELECT 'crm', upper(table_name), new_watermark + INTERVAL 1 DAY FROM batches
      UNION ALL SELECT '', 'crm.' || table_name, new_watermark + INTERVAL 2 DAY FROM batches)
    SELECT c.source_name, c.table_name, c.updated_at_col, c.pk_columns, c.delete_flag_col,
           coalesce(r.new_watermark, c.last_watermark) AS last_watermark,
           CASE WHEN r.table_name IS NULL THEN c.last_run_at ELSE {i.SQL_CHECKED_AT} END AS last_run_at
    FROM c LEFT JOIN r ON c.source_name = r.source_name AND c.table_name = r.table_name""",
)
def watermark_advance_clash(spark: SparkSession, sf: str) -> DataFrame:
    """Names that differ in case only, and one that reads like source and table of another: ten runs leave a row for each."""

    def thrice(df: DataFrame, newest: str | None) -> DataFrame:
        lower = df.withColumn("source_name", F.lit("crm"))
        upper = lower.withColumn("table_name", F.upper("table_name"))
        plain = df.withColumns({"source_name": F.lit(""), "table_name": F.concat(F.lit("crm."), F.col("table_name"))})
        if newest:
            upper = upper.withColumn(newest, F.col(newest) + F.expr("INTERVAL 1 DAY"))
            plain = plain.withColumn(newest, F.col(newest) + F.expr("INTERVAL 2 DAY"))
        return lower.unionByName(upper).unionByName(plain)

    results = thrice(i.batches(spark, sf).drop("row_count"), "new_watermark")
    return reduce(lambda control, _: ctl.advance(control, results, i.CHECKED_AT), range(10), thrice(i.control(spark, sf), None))


_FLAGGED = "o_orderkey % 7 = 0"


@query(
    "stream_late_changes",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus,
      CASE WHEN {_FLAGGED} THEN o_totalprice + 3 WHEN o_orderkey % 5 = 2 THEN o_totalprice + 5 ELSE o_totalprice END AS o_totalprice,
      o_orderdate, o_orderpriority,
      CASE WHEN {_FLAGGED} THEN o_orderdate + INTERVAL 3 DAY WHEN o_orderkey % 5 = 2 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS changed_at
    FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 14 = 7""",
)
def stream_late_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Three micro-batches: all orders; deletes of one in seven; then changes that come late.

    Of the deleted keys half come back with a newer change, half bring one older than their delete, which is not applied; of the others
    some bring a newer change and some one older than what the table holds.
    """
    root = run_folder(spark, "late")
    orders = i.table(spark, sf, "orders").withColumn("changed_at", F.col("o_orderdate"))
    live = LiveTable(spark, f"{_schema_name(root)}.orders", f"{root}/orders")

    def moved(rows: DataFrame, days: int, price: int = 0, gone: bool = False) -> DataFrame:
        at = F.col("o_orderdate") + F.expr(f"INTERVAL {days} DAY")
        return rows.withColumns({"changed_at": at, "o_totalprice": F.col("o_totalprice") + price, "is_deleted": F.lit(gone)})

    deleted = orders.where(_FLAGGED)
    kept = orders.where(f"NOT ({_FLAGGED})")
    late = [
        moved(deleted.where("o_orderkey % 14 = 0"), 1, 1),
        moved(deleted.where("o_orderkey % 14 = 7"), 3, 3),
        moved(kept.where("o_orderkey % 5 = 1"), -1, 4),
        moved(kept.where("o_orderkey % 5 = 2"), 1, 5),
    ]
    batches = [moved(orders, 0), moved(deleted, 2, gone=True), reduce(DataFrame.unionByName, late)]
    for number, rows in enumerate(batches):
        rows.write.mode("append").parquet(f"{root}/changes")
        changes = read_changes(spark, f"{root}/changes", rows.schema)
        running = apply_changes(spark, changes, live, ("o_orderkey",), "changed_at", f"{root}/checkpoint", root, "is_deleted", remember=10_000 * DAY, retention=0)
        running.awaitTermination()
    return live.read().drop("is_deleted")


@query(
    "cdc_sync_inclusive_published",
    f"""SELECT * REPLACE (CASE WHEN o_orderdate >= {i.SQL_LO} THEN o_totalprice ELSE o_totalprice - 1 END AS o_totalprice) FROM orders""",
)
def cdc_sync_inclusive_published(spark: SparkSession, sf: str) -> DataFrame:
    """Sync on stored cursors with run id and audit time: the stored cursor is the first one to read, and goes one microsecond past
    the last row, so the second run finds nothing."""
    root = run_folder(spark, "inclusive")
    live = _stale_live_table(spark, sf, root)
    store = WatermarkStore(spark, _schema_name(root), root)
    store.ensure()
    store.upsert([("orders", i.LO)], "run_0", i.LO)
    target = SyncTarget(SyncConfig("orders", ("o_orderkey",), "o_orderdate", mode="inclusive"), i.table(spark, sf, "orders"), live)
    for run_id, changes in ((i.RUN_ID, True), ("run_2", False)):
        (outcome,) = sync_many(spark, [target], store, root, run_id)
        if not outcome.ok or outcome.result.changed != changes:
            raise RuntimeError(outcome.error or f"{run_id}: {outcome.result.rows} rows")
    (row,) = store.read().collect()
    if row["updated_by_run"] != "run_2" or row["updated_at"] is None:
        raise RuntimeError(f"stored cursor: {row}")
    return live.read()


@query(
    "null_cursor_report",
    """SELECT 'events' AS table_name, count(*) FILTER (WHERE event_type <> 'click') AS cdc_row_count,
      count(*) FILTER (WHERE event_type = 'click') AS null_cursor_row_count FROM events
    UNION ALL SELECT 'orders', count(*) FILTER (WHERE o_orderkey % 10 <> 0), count(*) FILTER (WHERE o_orderkey % 10 = 0) FROM orders""",
)
def null_cursor_report(spark: SparkSession, sf: str) -> DataFrame:
    """What a run records of rows that have no cursor: one table is read between bounds, one past its cursor."""
    root = run_folder(spark, "nulls")
    schema = _schema_name(root)
    history = CdcHistory(spark, schema, root)
    events = i.table(spark, sf, "events").withColumn("ts", F.when(F.col("event_type") != "click", F.col("ts")))
    orders = i.table(spark, sf, "orders").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate")))
    targets = [
        SyncTarget(SyncConfig("events", ("event_id",), "ts"), events, LiveTable(spark, f"{schema}.events", f"{root}/events")),
        SyncTarget(SyncConfig("orders", ("o_orderkey",), "o_orderdate", mode="strict"), orders, LiveTable(spark, f"{schema}.orders", f"{root}/orders")),
    ]
    failed = [o.error for o in sync_many(spark, targets, WatermarkStore(spark, schema, root), root, i.RUN_ID, history) if not o.ok]
    if failed:
        raise RuntimeError(failed[0])
    told = history.read().select("table_name", "cdc_row_count", "null_cursor_row_count")
    kept = small_frame(spark, told.collect(), told.schema)  # a row per table
    delete_dir(spark, root)
    return kept


_KPIS = ("table_count", "ok_count", "failed_count", "mismatch_count", "mismatch_plus_failed", "problem_tables")
_DQ = ("cdc_mismatch", "cdc_failed", "full_mismatch", "full_failed", "full_problems", "all_clear")


def _figures_sql(frame: str, table: str, names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT '{frame}', '{n}', CAST({n} AS BIGINT) FROM {table}" for n in names)


def _kpi_sql(diff: str, ok: str, rows: str) -> str:
    failed = "upper(status) = 'FAILED'"
    return f"""SELECT count(*) AS table_count, count(*) FILTER (WHERE {ok}) AS ok_count, count(*) FILTER (WHERE {failed}) AS failed_count,
      count(*) FILTER (WHERE {diff} <> 0) AS mismatch_count, count(*) FILTER (WHERE {failed}) + count(*) FILTER (WHERE {diff} <> 0) AS mismatch_plus_failed,
      count(*) FILTER (WHERE {failed} OR {diff} <> 0) AS problem_tables FROM {rows}"""


@query(
    "report_frames",
    f"""WITH {i.CDC_H}, {i.FULL_H},
    lc AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY checked_at DESC NULLS LAST, dag_run_id) AS n FROM cdc_h) WHERE n = 1),
    lf AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY start_time DESC NULLS LAST, run_id) AS n FROM full_h) WHERE n = 1),
    kc AS ({_kpi_sql('row_count_diff', "upper(status) = 'SUCCESS' AND row_count_diff = 0", 'lc')}),
    kf AS ({_kpi_sql('count_diff', "upper(status) = 'SUCCESS'", 'lf')}),
    dq AS (SELECT kc.mismatch_count AS cdc_mismatch, kc.failed_count AS cdc_failed, kf.mismatch_count AS full_mismatch, kf.failed_count AS full_failed,
           kf.mismatch_count + kf.failed_count AS full_problems, kc.mismatch_plus_failed + kf.mismatch_plus_failed = 0 AS all_clear FROM kc, kf),
    t AS (SELECT coalesce(sum(cdc_row_count), 0) AS n FROM cdc_h WHERE checked_at >= {i.SQL_AS_OF}),
    r AS (SELECT * FROM cdc_h ORDER BY checked_at DESC NULLS LAST, dag_run_id LIMIT 20)
    SELECT * FROM (SELECT 'today' AS frame, 'today_change_count' AS name, CAST(n AS BIGINT) AS figure FROM t
    UNION ALL {_figures_sql('cdc_kpis', 'kc', _KPIS)} UNION ALL {_figures_sql('full_kpis', 'kf', _KPIS)} UNION ALL {_figures_sql('dq_summary', 'dq', _DQ)}
    UNION ALL SELECT 'attention', table_name, row_count_diff FROM lc WHERE upper(status) = 'FAILED' OR row_count_diff <> 0
    UNION ALL SELECT 'recent', table_name, cdc_row_count FROM r
    UNION ALL SELECT 'statuses', status, NULL FROM (SELECT status FROM cdc_h UNION SELECT status FROM full_h) WHERE status IS NOT NULL
    UNION ALL SELECT 'tables', table_name, NULL FROM (SELECT table_name FROM cdc_h UNION SELECT table_name FROM full_h) WHERE table_name IS NOT NULL)""",
)
def report_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Both histories are taken over but for the runs of the last hours, which are appended as runs; then the frames of the report,
    as rows of frame, name and figure."""
    root = run_folder(spark, "report")
    full, cdc = FullLoadHistory(spark, _schema_name(root), root), CdcHistory(spark, _schema_name(root), root)
    for history, rows, at in ((cdc, i.cdc_history(spark, sf), "checked_at"), (full, i.full_history(spark, sf), "start_time")):
        last = rows.agg((F.max(at) - F.expr("INTERVAL 2 HOUR")).alias("at")).first()["at"]
        history.load(rows.where((F.col(at) <= ntz(last)) | F.col(at).isNull()))
        history.append(rows.where(F.col(at) > ntz(last)))
    frames = report(full, cdc, i.CHECKED_AT)

    def figures(frame: str, names: tuple[str, ...]) -> DataFrame:
        pairs = F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).cast("bigint").alias("figure")) for n in names))
        return frames[frame].select(F.lit(frame).alias("frame"), F.explode(pairs).alias("x")).select("frame", "x.*")

    def listed(frame: str, name: str, figure: str | None) -> DataFrame:
        value = F.col(f"`{figure}`") if figure else F.lit(None)
        return frames[frame].select(F.lit(frame).alias("frame"), F.col(f"`{name}`").alias("name"), value.cast("bigint").alias("figure"))

    parts = [figures("cdc_kpis", _KPIS), figures("full_kpis", _KPIS), figures("dq_summary", _DQ), figures("today", ("today_change_count",))]
    parts += [listed("attention", "Table", "차이"), listed("recent", "Table", "이번 CDC"), listed("statuses", "status", None), listed("tables", "table_name", None)]
    return reduce(DataFrame.unionByName, parts)


@query(
    "gates_refuse",
    f"""SELECT 'staged whole' AS what, count(*) AS extracted_count, count(*) AS staged_count, true AS gate_ok FROM orders WHERE o_orderdate > {i.SQL_LO}
    UNION ALL SELECT 'staged in part', count(*), count(*) FILTER (WHERE o_orderpriority <> '1-URGENT'),
      count(*) = count(*) FILTER (WHERE o_orderpriority <> '1-URGENT') FROM orders WHERE o_orderdate > {i.SQL_LO}
    UNION ALL SELECT 'interval replaced', count(*), count(*), true FROM events WHERE ts >= {i.SQL_START} AND ts < {i.SQL_END}
    UNION ALL SELECT 'interval added to', count(*), 2 * count(*), count(*) = 0 FROM events WHERE ts >= {i.SQL_START} AND ts < {i.SQL_END}""",
)
def gates_refuse(spark: SparkSession, sf: str) -> DataFrame:
    """Both count gates beside what they are there to catch: files of a staged extract that are not whole, and an interval whose old
    rows are still there."""
    changed = extract_changes(i.table(spark, sf, "orders"), "o_orderdate", i.LO, STRICT)
    with run_directory(spark, run_folder(spark, "gates"), i.RUN_ID, "orders") as path:
        batch = stage(changed, changed.schema, path, "o_orderdate", ["o_orderkey"])
        staged = batch.read(spark)
        whole, part = staged.count(), staged.where("o_orderpriority <> '1-URGENT'").count()
    schema = T.StructType.fromDDL("row_count bigint")
    one = lambda n: small_frame(spark, [(n,)], schema)
    events = i.table(spark, sf, "events")
    new = extract_interval(events, "ts", i.START, i.END)
    replaced = replace_interval(events.withColumn("value", F.col("value") + 1), new, "ts", i.START, i.END)
    rows = lambda df: interval_count(df, "ts", i.START, i.END).withColumnRenamed("interval_rows", "row_count")
    cases = {
        "staged whole": (one(batch.rows), one(whole)),
        "staged in part": (one(batch.rows), one(part)),
        "interval replaced": (rows(events), rows(replaced)),
        "interval added to": (rows(events), rows(events.unionByName(new))),
    }
    return reduce(DataFrame.unionByName, [count_gate(*sides).select(F.lit(what).alias("what"), "*") for what, sides in cases.items()])


class _Miscounting(ParquetSource):
    """A source that has one row more than it sends of some tables."""

    def count(self, table: str) -> int:
        return super().count(table) + (table in ("nation", "orders"))


def _loaded_sql(table: str) -> str:
    off = int(table in ("nation", "orders"))
    message = f"concat('lake_{table} mismatch: source=', CAST(count(*) + 1 AS VARCHAR), ', target=', CAST(count(*) AS VARCHAR))" if off else "CAST(NULL AS VARCHAR)"
    return f"SELECT 'lake_{table}' AS table_name, '{'FAILED' if off else 'SUCCESS'}' AS status, count(*) + {off} AS pg_count, count(*) AS sf_count, CAST({off} AS BIGINT) AS count_diff, count(*) AS extracted_count, count(*) AS staged_count, {message} AS error_message FROM {table}"


@query("full_load_failures_record", " UNION ALL ".join(_loaded_sql(t) for t in TABLES))
def full_load_failures_record(spark: SparkSession, sf: str) -> DataFrame:
    """A load whose count gate finds two tables wanting: counts are those of the source, of the extract and of the staged files."""
    root = run_folder(spark, "miscounted")
    spec = SourceSpec("lake", "parquet", "public", _schema_name(root), {"path": sf})
    history = FullLoadHistory(spark, _schema_name(root), root)
    load_source(spark, spec, root, i.RUN_ID, history, source=_Miscounting(spark, spec))
    told = history.read().select("table_name", "status", "pg_count", "sf_count", "count_diff", "extracted_count", "staged_count", "error_message")
    kept = small_frame(spark, told.collect(), told.schema)
    delete_dir(spark, root)
    return kept


@query(
    "cdc_record_merged",
    f"""WITH t AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0),
    s AS (SELECT *, o_orderkey % 3 <> 0 AS matched FROM orders WHERE o_orderdate > {i.SQL_LO}),
    after AS (SELECT o_orderkey FROM t WHERE NOT (o_orderdate > {i.SQL_LO} AND o_orderstatus = 'P')
      UNION ALL SELECT o_orderkey FROM s WHERE NOT matched AND o_orderstatus <> 'P'),
    c AS (SELECT (SELECT count(*) FROM orders) AS source_row_count, (SELECT count(*) FROM after) AS target_row_count)
    SELECT 'orders' AS table_name, CASE WHEN source_row_count = target_row_count THEN 'SUCCESS' ELSE 'MISMATCH' END AS status,
      source_row_count, target_row_count, source_row_count - target_row_count AS row_count_diff, count(*) AS cdc_row_count,
      count(*) FILTER (WHERE NOT matched AND o_orderstatus = 'F') AS inserted_row_count,
      count(*) FILTER (WHERE matched AND o_orderstatus = 'F') AS updated_row_count,
      count(*) FILTER (WHERE matched AND o_orderstatus = 'P') AS deleted_row_count, max(o_orderdate) AS last_watermark,
      CAST(0 AS BIGINT) AS null_cursor_row_count FROM s, c GROUP BY source_row_count, target_row_count""",
)
def cdc_record_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The record of a sync, its change counts told by the merge itself: pending orders are flagged, open ones have no flag."""
    root = run_folder(spark, "merged")
    flag = F.when(F.col("o_orderstatus") == "P", True).when(F.col("o_orderstatus") == "F", False)
    orders = i.table(spark, sf, "orders").withColumn("is_deleted", flag)
    live = LiveTable(spark, f"{_schema_name(root)}.orders", f"{root}/orders", HashSlices(("o_orderkey",), 4))
    live.ensure(orders.schema)
    live.publish(live.write_version(orders.where("o_orderkey % 3 <> 0"), "initial"))
    control, history = ControlStore(spark, _schema_name(root), root), CdcHistory(spark, _schema_name(root), root)
    control.ensure()
    cfg = SyncConfig("orders", ("o_orderkey",), "o_orderdate", "is_deleted")
    control.append(small_frame(spark, [(cfg.table, cfg.cursor, "o_orderkey", "is_deleted", i.LO, i.LO, cfg.source)], control.columns))
    (outcome,) = sync_many(spark, [SyncTarget(cfg, orders, live)], control, root, i.RUN_ID, history)
    if not outcome.ok:
        raise RuntimeError(outcome.error)
    told = history.read().drop("dag_run_id", "checked_at", "last_cdc_run_at")
    kept = small_frame(spark, told.collect(), told.schema)
    delete_dir(spark, root)
    return kept


#: What each native type of the three maps is to become, and how much of it there is: one text of each order, cast.
_NUMBER, _TEXT, _DAY, _TIME, _FLAG, _JSON = "number", "text", "day", "time", "flag", "json"
_EXPECTED = {
    "postgres": {
        _NUMBER: "smallint,integer,bigint,numeric(12,2),real,double precision",
        _TEXT: "text,character varying(15),character(1),uuid,no such type",
        _FLAG: "boolean",
        _DAY: "date",
        _TIME: "timestamp without time zone",
        _JSON: "json,jsonb",
    },
    "mysql": {
        _NUMBER: "tinyint,smallint,mediumint,int(11),BIGINT,decimal(12,2),float,double",
        _TEXT: "varchar(15),char(1),text,longtext,no such type",
        _DAY: "date",
        _TIME: "datetime,timestamp",
        _JSON: "json",
    },
    "oracle": {
        _NUMBER: "NUMBER(12,2),FLOAT,number",
        _TEXT: "VARCHAR2(15),NVARCHAR2(15),CHAR(1),CLOB,no such type",
        _TIME: "DATE,TIMESTAMP(6)",
    },
}
_MEASURES_SQL = {
    _NUMBER: "sum(o_orderkey)",
    _TEXT: "sum(length(CAST(o_orderkey AS VARCHAR)))",
    _FLAG: "count(*) FILTER (WHERE o_orderkey % 2 = 0)",
    _DAY: "sum(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)))",
    _TIME: "sum(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)))",
    _JSON: "sum(o_orderkey)",
}


def _natives():
    for kind, groups in _EXPECTED.items():
        for group, names in groups.items():
            parts = re.findall(r"[^,(]+(?:\([^)]*\))?", names)
            yield from ((kind, native, group) for native in parts)


@query(
    "type_maps",
    " UNION ALL ".join(f"SELECT '{k}' AS source_kind, '{n}' AS native_type, count(*) AS kept, CAST({_MEASURES_SQL[g]} AS BIGINT) AS total FROM orders" for k, n, g in _natives()),
)
def type_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Every native type of all three maps: texts of all orders are cast to what the map says, and measured as what they have become."""
    orders = i.table(spark, sf, "orders")
    key, moment = F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    texts = {_FLAG: (F.col("o_orderkey") % 2 == 0).cast("string"), _DAY: F.substring(moment, 1, 10), _TIME: moment}
    columns, values, kinds = [], [], list(_natives())
    for k, (kind, native, group) in enumerate(kinds):
        found = re.search(r"\((\d+),(\d+)\)", native)
        become = spark_type(kind, native, *(map(int, found.groups()) if found else ()))
        value = typed(texts.get(group, key), T.StringType(), become)
        columns.append(value.alias(f"c{k}"))
        c = F.col(f"c{k}")
        total = {
            _NUMBER: F.sum(c).cast("bigint"),
            _TEXT: F.sum(F.char_length(c)),
            _FLAG: F.count_if(c.cast("boolean")),
            _DAY: F.sum(F.datediff(c, F.lit("1970-01-01").cast("date"))),
            _TIME: F.sum(F.datediff(c, F.lit("1970-01-01").cast("date"))),
            _JSON: F.sum(c.cast("bigint")),
        }[group]
        values.append(F.struct(F.lit(kind).alias("source_kind"), F.lit(native).alias("native_type"), F.count(c).alias("kept"), total.alias("total")))
    return orders.select(*columns).agg(F.array(*values).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
