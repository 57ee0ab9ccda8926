"""Whole-table loads: typed staging, count gate, then one move of the live table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.naming import target_name
from tablesync.functions.typemap import mapped_schema
from tablesync.operators.quality import GateFailed
from tablesync.operators.reconcile import full_load_records, reconcile_counts
from tablesync.plans import files
from tablesync.plans.fanout import DEFAULT_WIDTH, Outcome, fan_out
from tablesync.plans.frames import rows_frame, small_frame
from tablesync.plans.livetable import LiveTable
from tablesync.plans.staging import stage
from tablesync.plans.stores import FullLoadHistory
from tablesync.sources.registry import Source, SourceSpec, open_source

RETENTION = 86_400.0  # seconds that replaced files stay for readers that still use them
COUNTS = T.StructType(
    [T.StructField("table_name", T.StringType()), T.StructField("row_count", T.LongType())]
)
STAGED_COUNTS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("extracted_count", T.LongType()),
        T.StructField("staged_count", T.LongType()),
        T.StructField("started", T.TimestampNTZType()),
        T.StructField("ended", T.TimestampNTZType()),
    ]
)


@dataclass(frozen=True)
class LoadResult:
    table: str
    source_count: int
    extracted: int
    staged: int
    started: datetime
    ended: datetime

    @property
    def equal(self) -> bool:
        return self.source_count == self.staged


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def load_table(
    spark: SparkSession,
    source: Source,
    table: str,
    live: LiveTable,
    run_id: str,
    split_by: str | None = None,
    strict: bool = True,
    retention: float = RETENTION,
) -> LoadResult:
    """Load one table. The count gate runs on the staged files, before anything is published.

    The staged files become the live version as they are; the data is written once. With
    ``strict`` a difference raises, otherwise it is returned to be recorded. Either way the live
    table keeps its old content.
    """
    started = now()
    schema = mapped_schema(source.kind, source.columns(table))
    path = live.version_path(run_id)
    published = False
    try:
        source_count = source.count(table)
        batch = stage(source.read(table, split_by, source_count), schema, path, slices=live.slices)
        staged = batch.read(spark).count()
        if source_count != staged:
            if strict:
                raise GateFailed(f"{live.name}: source has {source_count} rows, staged {staged}")
        else:
            live.replace_definition(schema, path)
            published = True
            live.expire(retention)
        return LoadResult(live.name, source_count, batch.rows, staged, started, now())
    finally:
        if not published:
            files.delete_dir(spark, path)


def load_source(
    spark: SparkSession,
    spec: SourceSpec,
    root: str,
    run_id: str,
    history: FullLoadHistory | None = None,
    prefix: bool = True,
    width: int = DEFAULT_WIDTH,
    source: Source | None = None,
) -> list[Outcome]:
    """Load every table of a source, several at a time, and record each outcome, failures too.

    Nothing is raised for a table that failed: pass the outcomes to ``raise_failed`` for that.

    With ``prefix`` the target is named ``<source>_<table>``, so sources can share a schema.
    """
    source = source or open_source(spark, spec)

    def one(table: str) -> LoadResult:
        name = target_name(spec.name, table) if prefix else table
        live = LiveTable(spark, f"{spec.target_schema}.{name}", f"{root.rstrip('/')}/{name}")
        return load_table(spark, source, table, live, run_id, source.split_column(table), strict=history is None)

    outcomes = fan_out(spark, source.tables(), one, width)
    if history is not None:
        record(spark, history, outcomes, run_id)
    return outcomes


def load_all(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    root: str,
    run_id: str,
    history: FullLoadHistory | None = None,
    width: int = DEFAULT_WIDTH,
) -> dict[str, list[Outcome]]:
    """Every source by itself: one that cannot be opened or listed is one failed outcome, and the others go on."""
    loaded = {}
    for spec in specs:
        try:
            loaded[spec.name] = load_source(spark, spec, root, run_id, history, True, width)
        except Exception as failure:
            loaded[spec.name] = [Outcome(spec.name, None, f"{type(failure).__name__}: {failure}")]
            if history is not None:
                record(spark, history, loaded[spec.name], run_id)
    return loaded


def record(spark: SparkSession, history: FullLoadHistory, outcomes: list[Outcome], run_id: str) -> None:
    """One history row per table, written together: counts with real times, or FAILED with the error."""
    history.ensure()
    failed = [
        {"run_id": run_id, "pipeline_type": "FULL_LOAD", "table_name": o.item, "start_time": now(), "end_time": now(), "status": "FAILED", "error_message": o.error}
        for o in outcomes
        if not o.ok
    ]
    if failed:
        history.append(rows_frame(spark, failed, history.columns))
    results = [o.result for o in outcomes if o.ok]
    if not results:
        return
    name = lambda r: r.table.split(".")[-1]
    compared = reconcile_counts(
        small_frame(spark, [(name(r), r.source_count) for r in results], COUNTS),
        small_frame(spark, [(name(r), r.staged) for r in results], COUNTS),
        unequal="FAILED",
    )
    staged = small_frame(
        spark, [(name(r), r.extracted, r.staged, r.started, r.ended) for r in results], STAGED_COUNTS
    )
    history.append(full_load_records(compared, run_id, F.col("started"), F.col("ended"), staged))
