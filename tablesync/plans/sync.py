"""Incremental sync: stage, gate, merge, publish, and only then move the cursor."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, replace
from datetime import datetime, timedelta
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.flags import is_live
from tablesync.functions.typemap import conform, mapped_schema
from tablesync.operators.control import SOURCE_NAME, control_name
from tablesync.operators.extract import BOUNDED, INCLUSIVE, bounds_of_changes, extract_changes, null_cursor_rows, project, watched_changes
from tablesync.operators.merge import MATCHED, STAGED, MergeSpec, align, broadcast_safe, count_columns, merged_rows, require_unique, stays, without_stale
from tablesync.operators.metadata import cdc_eligible
from tablesync.operators.reconcile import cdc_records, reconcile_counts
from tablesync.plans.fanout import DEFAULT_WIDTH, Outcome, fan_out
from tablesync.plans.full_load import COUNTS, RETENTION, now
from tablesync.plans import files
from tablesync.plans.livetable import LiveTable, Slices
from tablesync.plans.frames import rows_frame, small_frame
from tablesync.plans.staging import StagedBatch, gate, key_size, run_directory, stage
from tablesync.plans.stores import CdcHistory, ControlStore, WatermarkStore
from tablesync.sources.jdbc import JdbcSource
from tablesync.sources.registry import SourceSpec, open_source

GROUPS_AT_ONCE = 4  # groups of slices merged side by side
_BROADCASTS = threading.BoundedSemaphore(GROUPS_AT_ONCE)  # of all tables that this driver syncs at once

CHANGES = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("cdc_row_count", T.LongType()),
        T.StructField("inserted_row_count", T.LongType()),
        T.StructField("updated_row_count", T.LongType()),
        T.StructField("deleted_row_count", T.LongType()),
        T.StructField("null_cursor_row_count", T.LongType()),
    ]
)
CURSORS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("last_watermark", T.TimestampNTZType()),
        T.StructField("last_run_at", T.TimestampNTZType()),
    ]
)
ELIGIBLE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("updated_at_col", T.StringType()),
        T.StructField("pk_columns", T.ArrayType(T.StringType())),
        T.StructField("delete_flag_col", T.StringType()),
    ]
)


@dataclass(frozen=True)
class SyncConfig:
    """What a table needs to be synced, as discovery found it."""

    table: str
    keys: tuple[str, ...]
    cursor: str
    delete_flag: str | None = None
    mode: str = BOUNDED
    overlap: timedelta | None = None
    active_only: bool = False  # compare with the source's live rows only
    source: str = ""  # where several sources are synced, their cursors are kept apart by it

    @property
    def control_name(self) -> str:
        """The table's name in histories and reports."""
        return control_name(self.source, self.table)

    @property
    def identity(self) -> tuple[str, str]:
        """What its cursor is kept by."""
        return self.source, self.table


@dataclass(frozen=True)
class SyncResult:
    table: str
    new_watermark: datetime
    rows: int = 0
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    source_rows: int | None = None
    target_rows: int | None = None
    #: Rows that have no cursor and so are never synced; unknown where nothing told.
    null_cursors: int | None = None

    @property
    def changed(self) -> bool:
        return self.rows > 0


def configs_from(eligible: DataFrame, **common) -> list[SyncConfig]:
    """Sync configurations of the eligible tables: one small row per table of the catalog."""
    return [
        SyncConfig(r["table_name"], tuple(r["pk_columns"]), r["updated_at_col"], r["delete_flag_col"], **common)
        for r in eligible.collect()
    ]


def eligible_frame(spark: SparkSession, configs: Sequence[SyncConfig]) -> DataFrame:
    rows = [(c.source, c.table, c.cursor, list(c.keys), c.delete_flag) for c in configs]
    return small_frame(spark, rows, T.StructType([SOURCE_NAME, *ELIGIBLE.fields]))


def merge_batch(
    spark: SparkSession,
    live: LiveTable,
    batch: StagedBatch,
    keys: Sequence[str],
    delete_flag: str | None,
    run_id: str,
    cursor: str | None = None,
    buried: LiveTable | None = None,
    unique: bool = False,
) -> tuple[int, int, int]:
    """Apply a staged batch to the live table; returns inserted, updated and deleted counts.

    With ``cursor``, rows older than what the table holds are not applied, nor those older than the delete of their key in
    ``buried``. ``unique`` says that the batch is known to have one row a key.

    Of a sliced table only the touched slices are read and written, in groups whose staged keys
    fit the broadcast bound. The keys of one group are broadcast, and its target is then never shuffled; the other groups of a
    big batch are shuffled, so that no more than the bound goes through the driver. The
    staged side was written to files first, so each use of it is a plain scan. All groups go live in one move,
    after the last of them is written; if one fails, nothing does.
    """
    live.evolve(batch.schema)
    whole = align(batch.read(spark), live.read())
    if not unique:
        require_unique(whole, keys)
    groups: list[tuple[list | None, bool]] = [(None, broadcast_safe(batch.rows, batch.key_bytes))]
    if live.slices:
        groups = slice_groups(live.slices_of(whole, key_size(keys)))

    def one(group: tuple[list | None, bool]) -> tuple[str, dict]:
        touched, small = group
        with _BROADCASTS if small else nullcontext():
            return _write_group(spark, live, batch, MergeSpec(tuple(keys), delete_flag, small, cursor), touched, run_id, buried)

    outcomes = fan_out(spark, groups, one, GROUPS_AT_ONCE)
    failed = [o.error for o in outcomes if not o.ok]
    if failed:
        for o in outcomes:
            if o.ok:
                files.delete_dir(spark, o.result[0])
        raise RuntimeError(f"{len(failed)} of {len(outcomes)} groups of slices failed, first: {failed[0]}")
    live.publish_all([(o.result[0], o.item[0]) for o in outcomes])
    counts = [o.result[1] for o in outcomes]
    return tuple(sum(c[f"{kind}_row_count"] for c in counts) for kind in ("inserted", "updated", "deleted"))


def _write_group(
    spark: SparkSession, live: LiveTable, batch: StagedBatch, spec: MergeSpec, touched: list | None, run_id: str, buried: LiveTable | None
) -> tuple[str, dict]:
    """Write the merged content of some slices, or of a whole unsliced table, in one job; returns its folder and change counts."""
    target = live.read(touched)
    staged = align(batch.read(spark, touched), target)
    if buried is not None:
        markers = buried.read(touched if buried.slices else None)
        staged = without_stale(staged, markers, spec.keys, spec.cursor, spec.broadcast_keys)
    rows, seen = merged_rows(target, staged, spec), Observation()
    watch = (seen, count_columns(rows, spec.delete_flag))
    path = live.write_version(rows, run_id, (MATCHED, STAGED), watch, stays(rows, spec))
    return path, seen.get


def slice_groups(sizes: dict) -> list[tuple[list, bool]]:
    """Pack touched slices, by their measured key sizes, into groups within the broadcast bound. The first may be broadcast; the
    joins of the others, and of a slice too big by itself, are left to Spark: all keys of a batch would pass the driver otherwise."""
    groups: list[tuple[list, bool]] = []
    current, rows, size = [], 0, 0
    for name, (more_rows, more_size) in sorted(sizes.items(), key=lambda item: item[1]):
        if current and not broadcast_safe(rows + more_rows, size + more_size):
            groups.append((current, not groups and broadcast_safe(rows, size)))
            current, rows, size = [], 0, 0
        current, rows, size = [*current, name], rows + more_rows, size + more_size
    if current:
        groups.append((current, not groups and broadcast_safe(rows, size)))
    return groups


class Incremental(Protocol):
    """What a source can tell and read of a table's changes itself, without sending other rows."""

    def newest(self, table: str, cursor: str, low: datetime) -> datetime | None: ...

    def null_cursors(self, table: str, cursor: str) -> int: ...

    def read_changes(self, table: str, cursor: str, low: datetime, mode: str, high: datetime | None, split_by: str) -> DataFrame: ...


def sync_table(
    spark: SparkSession,
    source: DataFrame,
    cfg: SyncConfig,
    live: LiveTable,
    low: datetime,
    staging_root: str,
    run_id: str,
    incremental: Incremental | None = None,
    retention: float = RETENTION,
) -> SyncResult:
    """One table past its cursor ``low``, up to and including the publish. The caller moves the cursor afterwards, so a
    failure anywhere before leaves it where it was and the batch is replayed; merging twice
    changes nothing. Rows without a cursor are counted by the pass that looks for changes."""
    live.ensure(source.schema)
    high, nulls, seen = None, None, None
    since = low - (cfg.overlap or timedelta(0))
    if incremental is not None:
        nulls = incremental.null_cursors(cfg.table, cfg.cursor)
    if cfg.mode == BOUNDED:
        # with an overlap, rows that were committed late count as well in a table that is quiet
        if incremental is not None:
            high = incremental.newest(cfg.table, cfg.cursor, since)
        else:
            high, nulls = bounds_of_changes(source, cfg.cursor, since).first()
        if high is None:
            return SyncResult(cfg.control_name, low, null_cursors=nulls)
    if incremental is not None:
        changed = conform(incremental.read_changes(cfg.table, cfg.cursor, since, cfg.mode, high, cfg.keys[0]), source.schema)
    elif cfg.mode == BOUNDED:
        changed = extract_changes(project(source, source.columns), cfg.cursor, low, cfg.mode, high, cfg.overlap)
    else:
        seen = Observation()
        changed = watched_changes(project(source, source.columns), cfg.cursor, seen, low, cfg.mode, cfg.overlap)
    changed = align(changed, live.read())  # keys hash to the live table's slices only under its types
    with run_directory(spark, staging_root, run_id, cfg.table) as path:
        batch = stage(changed, changed.schema, path, cfg.cursor, cfg.keys, live.slices, sort_by=cfg.cursor)
        if seen is not None:
            # a plan that turns out to be empty is cut short and tells nothing
            nulls = seen.get["null_cursors"] if batch.rows else null_cursor_rows(source, cfg.cursor).first()[0]
        if batch.rows == 0 or batch.max_cursor is None:
            return SyncResult(cfg.control_name, low, null_cursors=nulls)
        gate(spark, batch, cfg.table)
        counts = merge_batch(spark, live, batch, cfg.keys, cfg.delete_flag, run_id)
        live.expire(retention)
        step = timedelta(microseconds=1 if cfg.mode == INCLUSIVE else 0)
        reached = max(batch.max_cursor + step, low)  # an overlap may bring older rows only
        return SyncResult(cfg.control_name, reached, batch.rows, *counts, null_cursors=nulls)


@dataclass(frozen=True)
class SyncTarget:
    """A table to sync: its configuration, its source rows and its live table. The rows may be
    given as a function, called when the table's turn comes."""

    cfg: SyncConfig
    source: DataFrame | Callable[[], DataFrame]
    live: LiveTable
    #: Where the source can find changes itself, and count its rows without sending them.
    incremental: Incremental | None = None
    count: Callable[[], int] | None = None

    def rows(self) -> DataFrame:
        return self.source if isinstance(self.source, DataFrame) else self.source()


def sync_many(
    spark: SparkSession,
    targets: Sequence[SyncTarget],
    control: ControlStore | WatermarkStore,
    staging_root: str,
    run_id: str,
    history: CdcHistory | None = None,
    width: int = DEFAULT_WIDTH,
) -> list[Outcome]:
    """Sync tables side by side. Cursors of those that merged move together in one write; a table
    that failed keeps its cursor and is replayed next time."""
    control.ensure()
    control.register(eligible_frame(spark, [t.cfg for t in targets]))
    lows = control.watermarks([t.cfg.identity for t in targets])

    def one(target: SyncTarget) -> SyncResult:
        rows = target.rows()
        low = lows[target.cfg.identity]
        result = sync_table(spark, rows, target.cfg, target.live, low, staging_root, run_id, target.incremental)
        return result if history is None else counted(rows, target, result)

    outcomes = fan_out(spark, targets, one, width)
    done = [o for o in outcomes if o.ok]
    moved = now()
    control.advance([(o.item.cfg.identity, o.result.new_watermark) for o in done], run_id, moved)
    if history is not None:
        record(spark, history, done, run_id, moved)
        record_failures(spark, history, [o for o in outcomes if not o.ok], run_id)
    return outcomes


def sync_source(
    spark: SparkSession,
    spec: SourceSpec,
    root: str,
    control: ControlStore | WatermarkStore,
    run_id: str,
    history: CdcHistory | None = None,
    slices: Callable[[SyncConfig], Slices | None] = lambda cfg: None,
    width: int = DEFAULT_WIDTH,
    **options,
) -> list[Outcome]:
    """Discover the tables of a source that can be synced and sync them all.

    ``slices`` says how a table is laid out when it is first created; ``options`` go to every
    table's configuration.
    """
    source = open_source(spark, spec)
    found = cdc_eligible(source.column_frame(), source.constraint_frame(), source.key_usage_frame(), source.schema)

    def target(cfg: SyncConfig) -> SyncTarget:
        def rows() -> DataFrame:
            schema = mapped_schema(source.kind, source.columns(cfg.table))
            return conform(source.read(cfg.table), schema)

        live = LiveTable(spark, f"{spec.target_schema}.{cfg.table}", f"{root.rstrip('/')}/{cfg.table}", slices(cfg))
        if not isinstance(source, JdbcSource):
            return SyncTarget(cfg, rows, live)
        return SyncTarget(cfg, rows, live, source, lambda: source.count(cfg.table))

    targets = [target(cfg) for cfg in configs_from(found, source=spec.name, **options)]
    if not targets:
        raise ValueError(f"{spec.name}: no table has both a primary key and a cursor column")
    return sync_many(spark, targets, control, root, run_id, history, width)


def counted(rows: DataFrame, target: SyncTarget, result: SyncResult) -> SyncResult:
    """The result with the row counts of both sides, for the record."""
    if target.cfg.active_only:
        rows = rows.filter(is_live(rows, target.cfg.delete_flag))
    told = target.count is not None and not target.cfg.active_only
    return replace(result, source_rows=target.count() if told else rows.count(), target_rows=target.live.read().count())


def record_failures(spark: SparkSession, history: CdcHistory, outcomes: Sequence[Outcome], run_id: str) -> None:
    """A FAILED row for each table whose sync raised, so reports know of it."""
    if outcomes:
        history.ensure()
        rows = [{"dag_run_id": run_id, "table_name": o.item.cfg.control_name, "checked_at": now(), "status": "FAILED"} for o in outcomes]
        history.append(rows_frame(spark, rows, history.columns))


def record(spark: SparkSession, history: CdcHistory, outcomes: Sequence[Outcome], run_id: str, run_at: datetime) -> None:
    """One reconciliation row per synced table: counts of both sides, change counts, cursor. Rows are put together by their place in the
    run: tables of different sources may share a name in reports."""
    if not outcomes:
        return
    history.ensure()
    results = {str(k): o.result for k, o in enumerate(outcomes)}
    compared = reconcile_counts(
        small_frame(spark, [(k, r.source_rows) for k, r in results.items()], COUNTS),
        small_frame(spark, [(k, r.target_rows) for k, r in results.items()], COUNTS),
        unequal="MISMATCH",
    )
    counts = [(k, r.rows, r.inserted, r.updated, r.deleted, r.null_cursors) for k, r in results.items()]
    cursors = small_frame(spark, [(k, r.new_watermark, run_at) for k, r in results.items()], CURSORS)
    told = cdc_records(compared, small_frame(spark, counts, CHANGES), cursors, run_id, now())
    names = F.create_map(*(F.lit(x) for k, r in results.items() for x in (k, r.table)))
    history.append(told.withColumn("table_name", names[F.col("table_name")]))
