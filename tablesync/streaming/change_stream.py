"""Structured Streaming form of the sync.

Each micro-batch of change files is staged once and merged with the batch code. Progress lives in the stream's
checkpoint; a replayed micro-batch merges again and changes nothing, so the table is exactly-once
although the input is at-least-once.

Changes may come late. One that is older than the row the table holds is dropped by the merge itself, which compares cursors. Keys
that were deleted are kept beside the table with the cursor of the delete, so that an older change of theirs does not
insert them again; such markers are forgotten when they are older than the table's newest change by ``remember``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablesync.functions.flags import is_live
from tablesync.functions.typemap import by_folded_name
from tablesync.operators.merge import align, latest_per_merge_key, without_stale
from tablesync.plans.full_load import RETENTION
from tablesync.plans.livetable import HashSlices, LiveTable
from tablesync.plans.staging import StagedBatch, gate, run_directory, stage
from tablesync.plans.sync import merge_batch

__all__ = ["apply_changes", "deleted_keys", "read_changes", "without_stale"]

REMEMBER = timedelta(days=30)


def read_changes(
    spark: SparkSession, folder: str, schema: T.StructType, max_files: int | None = None, name_pattern: str | None = None
) -> DataFrame:
    """Stream of Parquet change files as they land in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if name_pattern is not None:
        reader = reader.option("pathGlobFilter", name_pattern)
    return reader.parquet(folder)


def deleted_keys(live: LiveTable) -> LiveTable:
    """The table of deleted keys and the cursors of their deletes, beside a table, in slices of its own keys if that has such."""
    slices = live.slices if isinstance(live.slices, HashSlices) else None
    return LiveTable(live.spark, f"{live.name}_deleted_keys", f"{live.root}_deleted_keys", slices)


def _bury(spark: SparkSession, graves: LiveTable, batch: StagedBatch, keys: Sequence[str], cursor: str, flag: str, run_id: str, remember: timedelta) -> None:
    """Add the deletes of a batch; of a key the newest counts. Only slices with new deletes are read and written."""
    staged = batch.read(spark)
    have = by_folded_name(staged.columns)
    names, at = [have[k.lower()] for k in keys], have[cursor.lower()]
    gone = staged.where(~is_live(staged, flag)).select(*names, F.col(f"`{at}`").alias(cursor))
    if gone.isEmpty():
        return
    graves.ensure(gone.schema)
    gone = align(gone, graves.read())
    touched = list(graves.slices_of(gone)) if graves.slices else None
    every = graves.read(touched).unionByName(gone)
    newest = every.groupBy(*names).agg(F.max(cursor).alias(cursor))
    if batch.max_cursor is not None:
        newest = newest.where(F.col(cursor).isNull() | (F.col(cursor) >= F.lit(batch.max_cursor - remember)))
    graves.publish(graves.write_version(newest, run_id), touched)


def apply_changes(
    spark: SparkSession,
    changes: DataFrame,
    live: LiveTable,
    keys: Sequence[str],
    cursor: str,
    checkpoint: str,
    staging_root: str,
    delete_flag: str | None = None,
    run_label: str = "stream",
    remember: timedelta = REMEMBER,
    retention: float = RETENTION,
) -> StreamingQuery:
    """Merge everything that has landed and stop; the next start takes only what is new.

    Within a micro-batch only the newest row of each key is applied, and none that is older than what the table holds or than
    the delete of its key. Replaced files of the table and of its deleted keys go after ``retention`` seconds.
    """
    live.ensure(changes.schema)
    graves = deleted_keys(live)

    def merge_micro_batch(batch: DataFrame, number: int) -> None:
        run_id = f"{run_label}-{number}"
        newest = align(latest_per_merge_key(batch, keys, cursor), live.read())
        with run_directory(spark, staging_root, run_id, live.name) as staging:
            staged = stage(newest, newest.schema, staging, cursor, keys, live.slices, sort_by=cursor)
            if not staged.rows:
                return
            gate(spark, staged, live.name)
            buried = graves if delete_flag and graves.exists() else None
            merge_batch(spark, live, staged, keys, delete_flag, run_id, cursor, buried, unique=True)
            if delete_flag:
                _bury(spark, graves, staged, keys, cursor, delete_flag, run_id, remember)
                if graves.exists():
                    graves.expire(retention)
            live.expire(retention)

    return (
        changes.writeStream.foreachBatch(merge_micro_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
