"""The small shared tables: cursors and run histories."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablesync.functions.coerce import utc_naive
from tablesync.operators.control import (
    CONTROL_SCHEMA,
    SOURCE_NAME,
    WATERMARK_SCHEMA,
    advance,
    init_control,
    lookup_watermarks,
    new_control_rows,
    upsert_watermarks,
)
from tablesync.functions.naming import path_safe
from tablesync.operators.report import latest_per
from tablesync.operators.reconcile import CDC_HISTORY, FULL_LOAD_HISTORY
from tablesync.plans.frames import small_frame
from tablesync.functions.typemap import conform
from tablesync.plans.livetable import DaySlices, LiveTable, MonthSlices

TABLE_NAMES = T.StructType([SOURCE_NAME, T.StructField("table_name", T.StringType())])
RESULT_SCHEMA = T.StructType([*TABLE_NAMES.fields, T.StructField("new_watermark", T.TimestampNTZType())])

Times = DaySlices | MonthSlices

#: A table: the name of its source ('' for a single one) and its exact name; a name alone is one of no source.
Identity = tuple[str, str] | str


def _identity(table: Identity) -> tuple[str, str]:
    return ("", table) if isinstance(table, str) else table


class _Store:
    """One row per table and run at most, so a single output file is right. Changes made by one
    process are serialised; only one run of a sync is allowed at a time."""

    def __init__(self, spark: SparkSession, schema_name: str, root: str, table: str, columns: T.StructType, slices: Times | None = None):
        self.spark = spark
        self.table = LiveTable(spark, f"{schema_name}.{table}", f"{root.rstrip('/')}/{table}", slices)
        self.columns = columns
        self._lock = threading.Lock()

    def ensure(self) -> None:
        with self._lock:
            self.table.ensure(self.columns)

    def read(self) -> DataFrame:
        return self.table.read()

    def _change(self, step: Callable[[DataFrame], DataFrame]) -> None:
        with self._lock:
            path = self.table.write_version(step(self.table.read()).coalesce(1), uuid.uuid4().hex)
            self.table.publish(path)
            self.table.expire()

    def append(self, rows: DataFrame) -> None:
        self._change(lambda kept: kept.unionByName(rows))


class ControlStore(_Store):
    """Cursor, key and flag per synced table."""

    def __init__(self, spark: SparkSession, schema_name: str, root: str):
        super().__init__(spark, schema_name, root, "cdc_control", T.StructType([*CONTROL_SCHEMA.fields, SOURCE_NAME]))

    def register(self, eligible: DataFrame) -> None:
        """Add rows for eligible tables that have none; nothing is written when all have one."""
        if not new_control_rows(eligible, self.read()).isEmpty():
            self._change(lambda control: init_control(control, eligible))

    def watermarks(self, tables: Sequence[Identity]) -> dict[Identity, datetime]:
        """Cursors of all tables of a run, in one job."""
        wanted = small_frame(self.spark, [_identity(t) for t in tables], TABLE_NAMES)
        found = {(r["source_name"], r["table_name"]): r["watermark"] for r in lookup_watermarks(wanted, self.read()).collect()}
        return {t: found[_identity(t)] for t in tables}

    def watermark(self, table: Identity) -> datetime:
        return self.watermarks([table])[table]

    def advance(self, results: Sequence[tuple[Identity, datetime]], run_id: str, run_at: datetime) -> None:
        """Store new cursors of all tables that merged, in one job."""
        if results:
            frame = _results(self.spark, results)
            self._change(lambda control: advance(control, frame, run_at))


class WatermarkStore(_Store):
    """Cursors with run id and audit time, for syncs that keep no control row."""

    def __init__(self, spark: SparkSession, schema_name: str, root: str):
        super().__init__(spark, schema_name, root, "cdc_watermarks", T.StructType([*WATERMARK_SCHEMA.fields, SOURCE_NAME]))

    def read(self) -> DataFrame:
        """The cursors of a single source; ``entries`` tells those of several apart."""
        return self.entries().select(*WATERMARK_SCHEMA.names)

    def entries(self) -> DataFrame:
        return self.table.read()

    def register(self, eligible: DataFrame) -> None:
        """Nothing to do: a table gets its row with its first cursor."""

    def watermarks(self, tables: DataFrame | Sequence[Identity]) -> DataFrame | dict[Identity, datetime]:
        if isinstance(tables, DataFrame):
            return lookup_watermarks(tables, self.entries(), "last_updated_at")
        wanted = small_frame(self.spark, [_identity(t) for t in tables], TABLE_NAMES)
        rows = lookup_watermarks(wanted, self.entries(), "last_updated_at").collect()
        found = {(r["source_name"], r["table_name"]): r["watermark"] for r in rows}
        return {t: found[_identity(t)] for t in tables}

    def upsert(self, results: Sequence[tuple[Identity, datetime]], run_id: str, now: datetime) -> None:
        if results:
            batches = _results(self.spark, results).withColumnRenamed("new_watermark", "max_updated_at")
            self._change(lambda stored: upsert_watermarks(stored, batches, run_id, now))

    advance = upsert


def _results(spark: SparkSession, results: Sequence[tuple[Identity, datetime]]) -> DataFrame:
    return small_frame(spark, [(*_identity(t), utc_naive(w)) for t, w in results], RESULT_SCHEMA)


class _History(_Store):
    """Rows of all runs, sliced by day or month. A run writes the slices of its own rows anew, so however many runs a day has, it is
    a file or a few, and closed days are never touched.

    Beside it stands the latest run of each table and status, brought up to date with every run, so that reports need not read
    the history. It names the state of the history it belongs to; one that is behind is made anew from the history. It is written by
    the tasks that pick the latest runs, which adaptive execution joins into one where tables are few.
    """

    def __init__(self, spark: SparkSession, schema_name: str, root: str, table: str, columns: T.StructType, slices: Times, run_column: str):
        super().__init__(spark, schema_name, root, table, columns, slices)
        self.time_column, self.run_column = slices.time_column, run_column
        self._latest = LiveTable(spark, f"{schema_name}.{table}_latest", f"{root.rstrip('/')}/{table}_latest")

    def append(self, rows: DataFrame) -> None:
        with self._lock:
            of_run = conform(rows, self.columns).collect()  # a row per table of one run
            if not of_run:
                return
            added = small_frame(self.spark, of_run, self.columns)
            days = list({self.table.slices.day(r[self.time_column]) for r in of_run})
            before = self._state()
            path = self.table.write_version(self.table.read(days).unionByName(added), uuid.uuid4().hex)
            self.table.publish(path, days)
            self._bring_up(self._latest.read().unionByName(added) if self._is_of(before) else self.table.read())
            self.table.expire()

    def load(self, rows: DataFrame) -> None:
        """Take over a whole history, of any size, in place of what is here."""
        with self._lock:
            self.table.ensure(self.columns)
            tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.spark.sparkContext.defaultParallelism)
            self.table.publish(self.table.write_version(rows, uuid.uuid4().hex, tasks=tasks))
            self._bring_up(self.table.read())

    def latest(self) -> DataFrame:
        """The latest run of each table and status."""
        with self._lock:
            if not self._is_of(self._state()):
                self._bring_up(self.table.read())
        return self._latest.read()

    def days(self) -> list[date]:
        """Days, or first days of months, that have rows, newest first."""
        return sorted(map(date.fromisoformat, self.table.manifest().live), reverse=True)

    def _state(self) -> str:
        return self.table.state()

    def _is_of(self, state: str) -> bool:
        return self._latest.exists() and any(path_safe(state) in p for p in self._latest.manifest().live.values())

    def _bring_up(self, rows: DataFrame) -> None:
        self._latest.ensure(self.columns)
        newest = latest_per(rows, ("table_name", "status"), self.time_column, self.run_column)
        self._latest.publish(self._latest.write_version(newest, self._state()))
        self._latest.expire()


class FullLoadHistory(_History):
    """Loads are some a day, so their slices are months."""

    def __init__(self, spark: SparkSession, schema_name: str, root: str):
        super().__init__(spark, schema_name, root, "migration_monitoring", FULL_LOAD_HISTORY, MonthSlices("start_time"), "run_id")


class CdcHistory(_History):
    def __init__(self, spark: SparkSession, schema_name: str, root: str):
        super().__init__(spark, schema_name, root, "cdc_monitoring", CDC_HISTORY, DaySlices("checked_at"), "dag_run_id")
