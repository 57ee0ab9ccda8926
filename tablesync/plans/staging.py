"""Typed staging of an extract, and what is measured while it is written."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.naming import path_safe
from tablesync.functions.typemap import conform
from tablesync.operators.quality import require_equal
from tablesync.plans import files
from tablesync.plans.livetable import SLICE, Slices, by_slice, sliced_schema, write_files


@dataclass(frozen=True)
class StagedBatch:
    """A staged extract: where it is, its schema, and figures from the pass that wrote it."""

    path: str
    schema: T.StructType
    rows: int
    max_cursor: datetime | None
    key_bytes: int
    slices: Slices | None = None

    def read(self, spark: SparkSession, only: Sequence | None = None) -> DataFrame:
        """By-name scan under the declared schema; an empty extract still has its columns. Of a
        batch laid out by slice, ``only`` some slices can be read."""
        schema = sliced_schema(self.schema, self.slices)
        df = spark.read.schema(schema).parquet(self.path)
        if self.slices and only is not None:
            df = df.filter(F.col(SLICE).isin(list(only)))
        return df.select(*[F.col(f"`{c}`") for c in self.schema.names])


def key_size(keys: Sequence[str]) -> Column:
    """Bytes a row's key takes in a hash relation, without the row's own overhead."""
    total = F.lit(0).cast("bigint")
    for key in keys:
        column = F.col(f"`{key}`")
        total = total + F.coalesce(F.octet_length(column.cast("string")), F.lit(0)) + F.lit(16)
    return total


def stage(
    df: DataFrame,
    schema: T.StructType,
    path: str,
    cursor: str | None = None,
    keys: Sequence[str] = (),
    slices: Slices | None = None,
    sort_by: str | None = None,
) -> StagedBatch:
    """Write an extract as typed Parquet. Row count, largest cursor and key size come from the same pass.

    With ``slices`` the files are laid out as those of a sliced table. ``sort_by`` orders the rows
    inside each file, so that row groups carry narrow ranges; nothing is shuffled for it.
    """
    seen = Observation()
    newest = (F.max(F.col(f"`{cursor}`")) if cursor else F.lit(None)).cast("timestamp_ntz")
    typed = by_slice(conform(df, schema), slices, sort_by)
    measured = typed.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        newest.alias("newest"),
        F.coalesce(F.sum(key_size(keys)), F.lit(0)).alias("key_bytes"),
    )
    write_files(measured, path, slices)
    figures = seen.get
    return StagedBatch(path, schema, figures["rows"], figures["newest"], figures["key_bytes"], slices)


def gate(spark: SparkSession, batch: StagedBatch, label: str) -> int:
    """Staged rows, read back, must be as many as were extracted."""
    staged = batch.read(spark).count()
    require_equal(f"{label}: staged rows", batch.rows, staged)
    return staged


@contextmanager
def run_directory(spark: SparkSession, root: str, run_id: str, table: str) -> Iterator[str]:
    """A staging folder of one run and table, removed whatever happens."""
    path = f"{root.rstrip('/')}/_staging/{path_safe(run_id)}/{table}-{uuid.uuid4().hex[:12]}"
    try:
        yield path
    finally:
        files.delete_dir(spark, path)
