"""Cursor identity, statements and snapshots of JDBC sources, rows without a cursor."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators import control as ctl
from tablesync.plans import sync
from tablesync.plans.livetable import LiveTable
from tablesync.plans.stores import CdcHistory, ControlStore, WatermarkStore
from tablesync.plans.sync import SyncConfig, SyncTarget
from tablesync.sources.registry import SourceSpec, open_source

T0 = datetime(2024, 1, 1)
DAY = timedelta(days=1)
ROWS = "id long, v long, at timestamp_ntz"
#: Source and table: names in two cases, one that reads like another's source and table, and a plain one.
TABLES = [("crm", "Orders"), ("crm", "orders"), ("", "crm.orders"), ("", "orders"), ("shop", "orders")]


def test_each_identity_has_one_row(spark, tmp_path, schema_name):
    store = ControlStore(spark, schema_name, str(tmp_path))
    store.ensure()
    configs = [SyncConfig(t, ("id",), "at", source=s) for s, t in TABLES]
    for run in range(4):
        store.register(sync.eligible_frame(spark, configs))
        store.advance([(t, T0 + (run + k) * DAY) for k, t in enumerate(TABLES)], f"r{run}", T0)
        assert store.read().count() == len(TABLES)
        assert store.watermarks(TABLES) == {t: T0 + (run + k) * DAY for k, t in enumerate(TABLES)}
    store.advance([(TABLES[1], T0 + 90 * DAY)], "r9", T0)
    assert store.watermark(TABLES[0]) == T0 + 3 * DAY and store.watermark(TABLES[1]) == T0 + 90 * DAY
    assert store.watermark(("crm", "ORDERS")) == T0 + 3 * DAY  # another spelling: the oldest counts


def test_each_identity_has_one_stored_cursor(spark, tmp_path, schema_name):
    store = WatermarkStore(spark, schema_name, str(tmp_path))
    store.ensure()
    for run in range(3):
        store.upsert([(t, T0 + (run + k) * DAY) for k, t in enumerate(TABLES)], f"r{run}", T0)
    rows = {(r.source_name, r.table_name): (r.last_updated_at, r.updated_by_run) for r in store.entries().collect()}
    assert rows == {t: (T0 + (2 + k) * DAY, "r2") for k, t in enumerate(TABLES)} and store.entries().count() == len(TABLES)
    store.upsert([(("shop", "ORDERS"), T0 + 50 * DAY)], "r3", T0)  # stands for the stored spelling
    assert store.entries().count() == len(TABLES) and store.watermarks([("shop", "orders")]) == {("shop", "orders"): T0 + 50 * DAY}


def test_results_that_repeat_a_table_do_not_add_rows(spark):
    control = spark.createDataFrame([("a", "u", "id", "", T0, T0)], ctl.CONTROL_SCHEMA)
    results = spark.createDataFrame([("a", T0 + DAY), ("a", T0 + 2 * DAY), ("A", T0 + 3 * DAY)], "table_name string, new_watermark timestamp_ntz")
    assert [r.last_watermark for r in ctl.advance(control, results, T0).collect()] == [T0 + 2 * DAY]


def test_tables_of_one_name_are_recorded_apart(spark, tmp_path, schema_name):
    control, history = ControlStore(spark, schema_name, f"{tmp_path}/c"), CdcHistory(spark, schema_name, f"{tmp_path}/h")
    targets = []
    for k, (source, name) in enumerate((("a", "b"), ("", "a.b"))):
        rows = spark.createDataFrame([(n, n, T0 + n * DAY) for n in range(k + 1)], ROWS)
        targets.append(SyncTarget(SyncConfig(name, ("id",), "at", source=source), rows, LiveTable(spark, f"{schema_name}.t{k}", f"{tmp_path}/t{k}")))
    assert all(o.ok for o in sync.sync_many(spark, targets, control, f"{tmp_path}/st", "r1", history))
    got = sorted((r.table_name, r.source_row_count, r.target_row_count, r.last_watermark) for r in history.read().collect())
    assert got == [("a.b", 1, 1, T0), ("a.b", 2, 2, T0 + DAY)]


@pytest.mark.parametrize("mode", ["bounded", "strict", "inclusive"])
def test_rows_without_a_cursor_are_reported(spark, tmp_path, schema_name, mode):
    history, store = CdcHistory(spark, schema_name, f"{tmp_path}/h"), WatermarkStore(spark, schema_name, f"{tmp_path}/w")
    rows = spark.createDataFrame([(1, 1, T0), (2, 2, None), (3, 3, T0 + DAY), (4, 4, None)], ROWS)
    target = SyncTarget(SyncConfig("t", ("id",), "at", mode=mode), rows, LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t"))
    found = [sync.sync_many(spark, [target], store, f"{tmp_path}/st", run, history)[0].result for run in ("r1", "r2")]
    assert [(r.rows, r.null_cursors) for r in found] == [(2, 2), (0, 2)]
    assert {(r.dag_run_id, r.null_cursor_row_count) for r in history.read().collect()} == {("r1", 2), ("r2", 2)}


# -- JDBC: statements as text, as no database is started ---------------------------------------


def opened(spark, kind, **spec):
    return open_source(spark, SourceSpec("s", kind, "S", "x", {"url": "jdbc:none"}, **spec))


@pytest.mark.parametrize(("kind", "mark"), [("postgres", '"'), ("mysql", "`"), ("oracle", '"')])
def test_statements_of_an_increment(spark, kind, mark):
    source = opened(spark, kind)
    q = lambda name: f"{mark}{name}{mark}"
    table, at = f"{q('S')}.{q('t')}", "TIMESTAMP '2024-01-01 00:00:00.000000'"
    strict = source.changed_text("u", T0, "strict", None)
    assert strict == f"{q('u')} > {at}" and source.changed_text("u", T0, "inclusive", None) == f"{q('u')} >= {at}"
    bounded = source.changed_text("u", T0, "bounded", T0 + DAY)
    assert bounded == f"{strict} AND {q('u')} <= TIMESTAMP '2024-01-02 00:00:00.000000'"
    assert source.changes_relation("t", strict) == f"(SELECT * FROM {table} WHERE {strict}) changes"
    assert source.changed_count_sql("t", strict) == f"SELECT COUNT(*) AS n FROM {table} WHERE {strict}"
    assert source.null_cursors_sql("t", "u") == f"SELECT COUNT(*) AS n FROM {table} WHERE {q('u')} IS NULL"
    assert source.quantiles_sql("t", "k", strict, 8) == (
        f"SELECT MIN(k) AS low FROM (SELECT {q('k')} AS k, NTILE(8) OVER (ORDER BY {q('k')}) AS part FROM {table} "
        f"WHERE ({strict}) AND {q('k')} IS NOT NULL) ranked GROUP BY part"
    )
    assert source.quantile_predicates("k", [7, 1, 7, 30]) == [f"{q('k')} < 7 OR {q('k')} IS NULL", f"{q('k')} >= 7 AND {q('k')} < 30", f"{q('k')} >= 30"]
    assert source.quantile_predicates("k", [3, 3]) == ["1 = 1"]
    assert [source.literal(v) for v in (5, date(2024, 1, 2), T0, "o'x")] == ["5", "DATE '2024-01-02'", at, "'o''x'"]


def test_ranges_cover_every_key_once(spark):
    keys = [1, 1, 1, 2, 5, 9, 9, 1000, 10**9, None]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    source = opened(spark, "mysql")
    predicates = source.quantile_predicates("k", [1, 2, 9, 1000])
    assert sum(rows.where(p).count() for p in predicates) == len(keys)


class Answers:
    """Stands for a database: answers by the statement's beginning, and keeps the statements."""

    def __init__(self, spark, source, monkeypatch, answers):
        self.asked = []

        def query(text):
            self.asked.append(text)
            return next(frame for part, frame in answers.items() if part in text)

        monkeypatch.setattr(source, "_query", query)


def test_three_catalog_statements_a_run(spark, monkeypatch):
    names = [f"t{k}" for k in range(30)]
    columns = [("S", t, c, "timestamp" if c == "updated_at" else "integer", n, None, None) for t in names for n, c in enumerate(("id", "updated_at"), 1)]
    frames = {
        "information_schema.columns": spark.createDataFrame(columns, "table_schema string, table_name string, column_name string, data_type string, ordinal_position int, num_precision int, num_scale int"),
        "table_constraints": spark.createDataFrame([("S", t, f"pk_{t}", "PRIMARY KEY") for t in names], "table_schema string, table_name string, constraint_name string, constraint_type string"),
        "key_column_usage": spark.createDataFrame([("S", t, f"pk_{t}", "id", 1) for t in names], "table_schema string, table_name string, constraint_name string, column_name string, ordinal_position int"),
    }
    source = opened(spark, "postgres")
    database = Answers(spark, source, monkeypatch, frames)
    monkeypatch.setattr(sync, "open_source", lambda *_: source)
    ran = []
    monkeypatch.setattr(sync, "sync_many", lambda spark, targets, *a, **k: ran.extend(targets))
    sync.sync_source(spark, SourceSpec("s", "postgres", "S", "x"), "root", None, "r1")
    for name in names:
        assert [c.name for c in source.columns(name)] == ["id", "updated_at"] and source.split_column(name) == "id"
    assert len(ran) == 30 and len(database.asked) == 3


def test_an_increment_asks_nothing_about_the_whole_table(spark, tmp_path, schema_name, monkeypatch):
    source = opened(spark, "postgres", connections=4)
    rows = spark.createDataFrame([(n, n, T0 + n * DAY) for n in range(1, 6)], ROWS)
    count = lambda n: spark.createDataFrame([(n,)], "n long")
    answers = {
        "MAX(": spark.createDataFrame([(T0 + 5 * DAY,)], "upper_watermark timestamp_ntz"),
        "IS NULL": count(3),
        "NTILE": spark.createDataFrame([(1,), (3,), (4,)], "low long"),
        "COUNT(*)": count(2_500_000),
    }
    database, loaded, split = Answers(spark, source, monkeypatch, answers), [], []
    monkeypatch.setattr(source, "_load", lambda relation, **_: loaded.append(relation) or rows)
    reader = type(spark.read)
    monkeypatch.setattr(reader, "jdbc", lambda self, url, table, predicates, properties: split.extend(predicates) or rows)
    live = LiveTable(spark, f"{schema_name}.t", f"{tmp_path}/t")
    result = sync.sync_table(spark, rows, SyncConfig("t", ("id",), "at"), live, T0, f"{tmp_path}/st", "r1", source)
    assert (result.rows, result.null_cursors, result.new_watermark) == (5, 3, T0 + 5 * DAY)
    assert all(" WHERE " in text for text in database.asked + loaded) and len(database.asked) == 4
    assert split == ['"id" < 3 OR "id" IS NULL', '"id" >= 3 AND "id" < 4', '"id" >= 4']


def test_history_takes_over_and_keeps_the_latest(spark, tmp_path, schema_name):
    history = CdcHistory(spark, schema_name, str(tmp_path))
    rows = [("r1", "a", T0, "SUCCESS"), ("r2", "a", T0 + DAY, "FAILED"), ("r1", "b", T0, "SUCCESS"), ("r3", None, None, "SUCCESS")]
    frame = lambda rows: spark.createDataFrame(rows, "dag_run_id string, table_name string, checked_at timestamp_ntz, status string")
    history.load(frame(rows))
    newest = lambda: sorted((r.dag_run_id, r.table_name, r.status) for r in history.latest().where("table_name IS NOT NULL").collect())
    assert newest() == [("r1", "a", "SUCCESS"), ("r1", "b", "SUCCESS"), ("r2", "a", "FAILED")]
    history.append(frame([("r4", "a", T0 + 2 * DAY, "SUCCESS"), ("r4", "c", T0 + 2 * DAY, "SUCCESS")]))
    assert newest() == [("r1", "b", "SUCCESS"), ("r2", "a", "FAILED"), ("r4", "a", "SUCCESS"), ("r4", "c", "SUCCESS")]
    # a run that published its rows and went no further: the latest table is made anew
    more = frame([("r5", "b", T0 + 3 * DAY, "SUCCESS")]).select(*(F.col(f.name) if f.name in rows_of() else F.lit(None).cast(f.dataType).alias(f.name) for f in history.columns.fields))
    history.table.publish(history.table.write_version(more, "x"), [date(2024, 1, 4)])
    assert ("r5", "b", "SUCCESS") in newest()
    assert isinstance(history.columns, T.StructType) and history.days()[0] == date(2024, 1, 4)


def rows_of():
    return {"dag_run_id", "table_name", "checked_at", "status"}
