"""What several corpus operators share: scratch tables and small expressions."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.plans.files import delete_dir, run_folder

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def whole(column: str) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a batch that goes to a Python worker: JVM and worker hold some copies of it each.
BATCH_BYTES = "16m"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """SQL settings (dots as double underscores) that hold inside."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action that is finished are deleted, not kept until the driver collects its garbage; Python workers get
    small batches."""
    with settings(spark, **{SHUFFLE_CLEANUP: "true", "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}):
        yield


class Scratch:
    """Parquet tables in the folder that all executors share; each cuts the lineage of what reads it.

    A lost executor costs the tasks that ran on it: what is written stays, until `dropping_scratch` ends.
    """

    made: list[Scratch] = []

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = run_folder(spark, label)
        Scratch.made.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        with dropping_shuffles(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            delete_dir(self.spark, self.path(name))


@contextmanager
def dropping_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that operators make inside are deleted at the end: results are to be written or collected by then."""
    before = len(Scratch.made)
    try:
        yield
    finally:
        for scratch in Scratch.made[before:]:
            delete_dir(spark, scratch.root)
        del Scratch.made[before:]


def unused(name: str, columns: list[str]) -> str:
    """A column name like ``name`` that none of ``columns`` has, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Marks that are broadcast at most, whatever the corpus.
MARKS = 1 << 20


def maybe_among(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` (any columns, one of them ``key``) without most of those whose key is not in ``wanted``: told by a broadcast of at
    most ``MARKS`` numbers, so nothing is shuffled. None that is wanted is lost."""
    mark = F.pmod(F.xxhash64(F.col(key)), F.lit(MARKS)).alias("__mark")
    return rows.withColumn("__mark", mark).join(F.broadcast(wanted.select(mark).distinct()), "__mark", "left_semi").drop("__mark")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether nothing may be learned from a row."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0


def batch_parts(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in parts of about ``size`` bytes."""
    rows = max(1, math.ceil(batch.num_rows * size / max(size, batch.nbytes)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
