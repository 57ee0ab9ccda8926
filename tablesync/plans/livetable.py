"""A published table: a view over Parquet files that moves to new content in one call.

New content is always written beside the old. A publish registers the files of all slices in a catalog entry of its own, in
batched calls, and then replaces the view: readers see all of a batch or nothing of it, whatever number of slices it touches,
and a publish that stops half-way leaves the view where it was. Columns may change with the content.

A big table can be sliced, by a hash of its key or by day; a batch then reads and rewrites only the slices it touches.

A manifest, one small file that the view names, lists the folder of each slice, and which folders and entries were replaced when.
Expiry reads it and lists the table's folder once; it asks the catalog nothing about slices.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.coerce import utc_naive
from tablesync.functions.naming import path_safe, quote, text_literal
from tablesync.functions.typemap import conform, ddl_columns
from tablesync.plans import files

SLICE = "sync_slice"
LAYOUT, ENTRY, MANIFEST = "sync.slices", "sync.entry", "sync.manifest"
REGISTERED_AT_ONCE = 1000  # slices of one catalog call
_NO_DAY = "0001-01-01"  # slice of rows without a time


@dataclass(frozen=True)
class HashSlices:
    """``count`` slices by a hash of the key columns. The count is fixed for the table's life."""

    keys: tuple[str, ...]
    count: int
    type_name: str = "int"

    def column(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.count)).cast("int")


@dataclass(frozen=True)
class DaySlices:
    """One slice per day of a time column."""

    time_column: str
    type_name: str = "date"

    def column(self) -> Column:
        return F.coalesce(F.to_date(F.col(f"`{self.time_column}`")), F.lit(_NO_DAY).cast("date"))

    @staticmethod
    def day(at: datetime | None) -> date:
        """The slice of a row with this time."""
        return at.date() if at else date.fromisoformat(_NO_DAY)

    @staticmethod
    def days(start: datetime | str, end: datetime | str) -> list[date]:
        """Days a half-open interval touches."""
        first, stop = utc_naive(start), utc_naive(end)
        if stop <= first:
            return []
        last = (stop - timedelta(microseconds=1)).date()
        return [first.date() + timedelta(days=i) for i in range((last - first.date()).days + 1)]


@dataclass(frozen=True)
class MonthSlices:
    """One slice per month of a time column, named by its first day."""

    time_column: str
    type_name: str = "date"

    def column(self) -> Column:
        return F.coalesce(F.trunc(F.to_date(F.col(f"`{self.time_column}`")), "month"), F.lit(_NO_DAY).cast("date"))

    @staticmethod
    def day(at: datetime | None) -> date:
        """The slice of a row with this time."""
        return at.date().replace(day=1) if at else date.fromisoformat(_NO_DAY)


Slices = HashSlices | DaySlices | MonthSlices


def layout_text(slices: Slices | None) -> str:
    """The layout as the catalog entry keeps it."""
    if slices is None:
        return json.dumps(None)
    if isinstance(slices, HashSlices):
        return json.dumps({"hash": list(slices.keys), "count": slices.count})
    return json.dumps({"month" if isinstance(slices, MonthSlices) else "day": slices.time_column})


def layout_of(text: str) -> Slices | None:
    kept = json.loads(text)
    if kept is None:
        return None
    if "hash" in kept:
        return HashSlices(tuple(kept["hash"]), kept["count"])
    return MonthSlices(kept["month"]) if "month" in kept else DaySlices(kept["day"])


def sliced_schema(schema: T.StructType, slices: Slices | None) -> T.StructType:
    if slices is None:
        return schema
    return T.StructType([*schema.fields, T.StructField(SLICE, T.DataType.fromDDL(slices.type_name))])


def by_slice(df: DataFrame, slices: Slices | None, sort_by: str | None = None, tasks: int | None = None) -> DataFrame:
    """Bring rows of a slice together before a partitioned write. Adaptive execution splits a
    slice that is too big for one task and joins those that are too small. Where very many slices are small each, the files
    and not the rows take the time: ``tasks`` deals them over so many."""
    if slices is None:
        return df.sortWithinPartitions(F.col(f"`{sort_by}`")) if sort_by else df
    df = df.withColumn(SLICE, slices.column())
    df = df.hint("rebalance", SLICE) if tasks is None else df.repartition(tasks, SLICE)
    if sort_by:
        df = df.sortWithinPartitions(SLICE, F.col(f"`{sort_by}`"))
    return df.drop(SLICE)


def write_files(df: DataFrame, path: str, slices: Slices | None) -> None:
    if slices is None:
        df.write.parquet(path)
    else:
        df.withColumn(SLICE, slices.column()).write.partitionBy(SLICE).parquet(path)


@dataclass(frozen=True)
class Manifest:
    """What is live and what was replaced, paths relative to the table's folder; times are milliseconds.

    An unsliced table is one slice, named ''.
    """

    entry: str
    live: dict[str, str] = field(default_factory=dict)
    replaced: list[tuple[str, int]] = field(default_factory=list)
    entries: list[tuple[str, int]] = field(default_factory=list)

    @staticmethod
    def of(text: str) -> Manifest:
        kept = json.loads(text)
        return Manifest(kept["entry"], kept["live"], [tuple(x) for x in kept["replaced"]], [tuple(x) for x in kept["entries"]])


def _stamp() -> str:
    """Of its own, and with its time: not every store keeps one for folders."""
    return f"{int(time.time() * 1000)}-{uuid.uuid4().hex[:12]}"


def _written(name: str) -> int | None:
    """Milliseconds in the name of a version, an entry or a manifest."""
    found = name.replace("_", "-").removesuffix(".json").rsplit("-", 2)
    return int(found[1]) if len(found) == 3 and found[1].isdigit() else None


def entries_of(schema: str) -> str:
    return f"{schema}__entries"


def live_names(spark: SparkSession, schema: str) -> set[str]:
    """Lower-case names of the live tables of a schema."""
    if not spark.catalog.databaseExists(entries_of(schema)):
        return set()
    listed = spark.sql(f"SHOW TABLES IN {quote('spark', entries_of(schema))}").collect()
    return {r["tableName"].rsplit("__", 1)[0].lower() for r in listed}


class LiveTable:
    """``name`` is ``schema.table``; ``root`` is the table's folder on shared storage.

    ``slices`` is the layout of a table that is yet to be created. One that exists keeps the layout it was created
    with, whatever is given here: rows are where that layout has put them.
    """

    def __init__(self, spark: SparkSession, name: str, root: str, slices: Slices | None = None):
        self.spark = spark
        self.name = name
        self.root = root.rstrip("/")
        self._slices = slices
        self._layout_is_stored = False
        self.sql_name = ".".join(quote("spark", p) for p in name.split("."))

    # -- definition --------------------------------------------------------------------------

    def _properties(self) -> dict[str, str]:
        kept = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.sql_name}").collect()}
        if LAYOUT not in kept:
            raise ValueError(f"{self.name} was not created as a live table: its layout is not known")
        return kept

    @property
    def slices(self) -> Slices | None:
        if not self._layout_is_stored and self.exists():
            self._slices, self._layout_is_stored = layout_of(self._properties()[LAYOUT]), True
        return self._slices

    def manifest(self) -> Manifest:
        return Manifest.of(files.read_text(self.spark, f"{self.root}/{self._properties()[MANIFEST]}"))

    def state(self) -> str:
        """A name of the current content; each publish gives another."""
        return self._properties()[ENTRY]

    def _write_manifest(self, manifest: Manifest) -> str:
        name = f"manifest-{_stamp()}.json"
        files.write_text(self.spark, f"{self.root}/{name}", json.dumps(asdict(manifest)))
        return name

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.sql_name)

    def ensure(self, schema: T.StructType) -> None:
        """Create the table if it is absent, otherwise add the columns it lacks."""
        if self.exists():
            self.evolve(schema)
        else:
            self._create(schema, {})

    def _create(self, schema: T.StructType, live: dict[str, str]) -> None:
        if "." in self.name:
            for database in (self.name.split(".")[0], self._entry_schema()):
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote('spark', database)}")
        entry = self._new_entry(schema, live)
        self._move(schema, entry, self._write_manifest(Manifest(entry, live)))

    def _entry_schema(self) -> str:
        """Entries have a schema of their own, so that listings of the tables show views only."""
        return entries_of(self.name.split(".")[0]) if "." in self.name else ""

    def _sql_entry(self, entry: str) -> str:
        return ".".join(quote("spark", p) for p in (self._entry_schema(), entry) if p)

    def _new_entry(self, schema: T.StructType, live: dict[str, str]) -> str:
        """A catalog entry over the folders of all slices; no reader knows of it yet."""
        entry = f"{self.name.split('.')[-1]}__{_stamp()}".replace("-", "_")
        location, columns, partitioning = f"{self.root}/empty", ddl_columns(schema), ""
        files.make_dir(self.spark, location)
        if self.slices:
            columns += f", {SLICE} {self.slices.type_name}"
            partitioning = f"PARTITIONED BY ({SLICE})"
        elif live:
            location = self._path(live[""])
        self.spark.sql(f"CREATE TABLE {self._sql_entry(entry)} ({columns}) USING parquet {partitioning} LOCATION {text_literal(location)}")
        if self.slices:
            parts = [f"PARTITION ({SLICE} = {text_literal(v)}) LOCATION {text_literal(self._path(p))}" for v, p in sorted(live.items())]
            for at in range(0, len(parts), REGISTERED_AT_ONCE):
                self.spark.sql(f"ALTER TABLE {self._sql_entry(entry)} ADD {' '.join(parts[at : at + REGISTERED_AT_ONCE])}")
        return entry

    def _move(self, schema: T.StructType, entry: str, manifest: str) -> None:
        """The one call by which readers see other content."""
        kept = {LAYOUT: layout_text(self.slices), ENTRY: entry, MANIFEST: manifest}
        properties = ", ".join(f"'{k}' = {text_literal(v)}" for k, v in kept.items())
        columns = ", ".join(quote("spark", f.name) for f in schema.fields)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.sql_name} TBLPROPERTIES ({properties}) AS SELECT {columns} FROM {self._sql_entry(entry)}")

    def evolve(self, schema: T.StructType) -> list[str]:
        """Add columns the source has and the table lacks; names are compared without case."""
        now = self.schema()
        have = {c.lower() for c in now.names}
        new = [f for f in schema.fields if f.name.lower() not in have]
        if new:
            kept = self._properties()
            entry = self._sql_entry(kept[ENTRY])
            known = {c.lower() for c in self.spark.table(entry).columns}  # an attempt cut short may have added some
            lacking = [f for f in new if f.name.lower() not in known]
            if lacking:
                self.spark.sql(f"ALTER TABLE {entry} ADD COLUMNS ({ddl_columns(T.StructType(lacking))})")
            self._move(T.StructType([*now.fields, *new]), kept[ENTRY], kept[MANIFEST])
        return [f.name for f in new]

    # -- reading -----------------------------------------------------------------------------

    def read(self, slices: Iterable | None = None) -> DataFrame:
        """Current content, or that of some slices only; other slices are not even listed."""
        if slices is None or not self.slices:
            return self.spark.table(self.sql_name)
        entry = self.spark.table(self._sql_entry(self._properties()[ENTRY]))
        return entry.filter(F.col(SLICE).isin(list(slices))).drop(SLICE)

    def schema(self) -> T.StructType:
        return self.read().schema

    def slices_of(self, batch: DataFrame, size: Column | None = None) -> dict:
        """Slices a batch touches, each with its rows and the sum of ``size``: one small row per
        slice, whatever the batch holds."""
        per_slice = batch.groupBy(self.slices.column().alias(SLICE)).agg(
            F.count("*").alias("rows"), F.sum(F.lit(0) if size is None else size).alias("bytes")
        )
        return {r[SLICE]: (r["rows"], r["bytes"]) for r in per_slice.collect()}

    # -- publishing --------------------------------------------------------------------------

    def _path(self, relative: str) -> str:
        return relative if "/" in relative and not relative.startswith("v-") else f"{self.root}/{relative}"

    def _relative(self, path: str) -> str:
        return path.rstrip("/").removeprefix(f"{self.root}/")

    def version_path(self, run_id: str) -> str:
        """A folder no other attempt uses, so a replayed run never writes over files that may be
        live already. Leftovers of failed attempts go with ``expire``."""
        return f"{self.root}/v-{path_safe(run_id)}-{_stamp()}"

    def write_version(
        self,
        df: DataFrame,
        run_id: str,
        marks: Sequence[str] = (),
        watch: tuple[Observation, list[Column]] | None = None,
        keep: Column | None = None,
        tasks: int | None = None,
    ) -> str:
        """Write content beside the live files. Nothing a reader sees changes.

        ``watch`` observes the rows in the last stage, behind the shuffle by slice, so that a stage that is run again does not count
        twice; then ``keep`` drops rows. Both may use columns that are not written, named in ``marks``.
        """
        path, schema = self.version_path(run_id), self.schema()
        rows = by_slice(conform(df, T.StructType([*schema.fields, *[df.schema[m] for m in marks]])), self.slices, tasks=tasks)
        if watch is not None:
            rows = rows.observe(watch[0], *watch[1])
        if keep is not None:
            rows = rows.where(keep)
        try:
            write_files(rows.drop(*marks), path, self.slices)
        except Exception:
            files.delete_dir(self.spark, path)
            raise
        return path

    def read_version(self, path: str) -> DataFrame:
        return self.spark.read.schema(sliced_schema(self.schema(), self.slices)).parquet(path).drop(SLICE)

    def publish(self, path: str, touched: Iterable | None = None) -> None:
        """Make a written version live. For a sliced table only ``touched`` slices move (all, if
        not given); a touched slice the version has no rows for is dropped, so deletes that
        empty a slice take effect."""
        self.publish_all([(path, touched)])

    def publish_all(self, versions: Iterable[tuple[str, Iterable | None]], schema: T.StructType | None = None) -> None:
        """Make several written versions, of different slices, live in one move."""
        schema, before = schema or self.schema(), self.manifest()
        live = dict(before.live)
        for path, touched in versions:
            written = self._written_slices(path)
            for value in set(live) | set(written) if touched is None or not self.slices else {str(t) for t in touched}:
                if value in written:
                    live[value] = written[value]
                else:
                    live.pop(value, None)
        entry, at = self._new_entry(schema, live), int(time.time() * 1000)
        replaced = [*before.replaced, *[(p, at) for v, p in before.live.items() if live.get(v) != p]]
        manifest = self._write_manifest(Manifest(entry, live, replaced, [*before.entries, (before.entry, at)]))
        self._move(schema, entry, manifest)

    def _written_slices(self, path: str) -> dict[str, str]:
        """Folders of the slices of a written version."""
        if not self.slices:
            return {"": self._relative(path)}
        names = [n for n in files.list_names(self.spark, path) if n.startswith(f"{SLICE}=")]
        return {n.removeprefix(f"{SLICE}="): f"{self._relative(path)}/{n}" for n in names}

    def replace_definition(self, schema: T.StructType, path: str) -> None:
        """Put new content with another schema in place, whatever has changed in it; a table that is absent is created with it."""
        if self.exists():
            self.publish_all([(path, None)], schema)
        else:
            self._create(schema, self._written_slices(path))

    # -- upkeep ------------------------------------------------------------------------------

    def expire(self, keep_seconds: float = 86_400) -> list[str]:
        """Delete what was replaced more than ``keep_seconds`` ago, which is how long a reader that planned on an older version may
        still run, and what attempts that failed as long ago have left. Returns the folders of replaced slices."""
        cutoff, current = (time.time() - keep_seconds) * 1000, self._properties()[MANIFEST]
        kept = Manifest.of(files.read_text(self.spark, f"{self.root}/{current}"))
        gone = [p for p, at in kept.replaced if at < cutoff]
        old = [e for e, at in kept.entries if at < cutoff]
        for path in gone:
            files.delete_dir(self.spark, self._path(path))
        for entry in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._sql_entry(entry)}")  # external: files are not its own
        if gone or old:
            left = Manifest(kept.entry, kept.live, [x for x in kept.replaced if x[1] >= cutoff], [x for x in kept.entries if x[1] >= cutoff])
            current = self._write_manifest(left)
            self.spark.sql(f"ALTER VIEW {self.sql_name} SET TBLPROPERTIES ('{MANIFEST}' = {text_literal(current)})")
            kept = left
        self._sweep(kept, current, cutoff)
        return [self._path(p) for p in gone]

    def _sweep(self, kept: Manifest, current: str, cutoff: float) -> None:
        """Versions, manifests and entries that nothing names: one listing of the folder, one of the schema's tables."""
        named = {p.split("/")[0] for p in [*kept.live.values(), *[p for p, _ in kept.replaced]]} | {current}
        orphans = False
        for name in files.list_names(self.spark, self.root):
            at = _written(name) if name.startswith(("v-", "manifest-")) else None
            if at is not None and at < cutoff and name not in named:
                files.delete_dir(self.spark, f"{self.root}/{name}")
                orphans = True
        if orphans:
            for entry in self._entries():
                if entry not in {kept.entry, *[e for e, _ in kept.entries]} and _written(entry) < cutoff:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._sql_entry(entry)}")

    def _entries(self) -> list[str]:
        """All catalog entries of this table, those of failed publishes too."""
        table, schema = self.name.split(".")[-1], self._entry_schema()
        place = f"IN {quote('spark', schema)} " if schema else ""
        names = [r["tableName"] for r in self.spark.sql(f"SHOW TABLES {place}LIKE {text_literal(table + '__*')}").collect()]
        own = f"{table}__".lower()
        return [n for n in names if n.lower().startswith(own) and n.lower().removeprefix(own).count("_") == 1 and _written(n) is not None]

    def drop(self) -> None:
        """Remove the catalog entries and all files."""
        if self.exists():
            self.spark.sql(f"DROP VIEW {self.sql_name}")
            for entry in self._entries():
                self.spark.sql(f"DROP TABLE IF EXISTS {self._sql_entry(entry)}")
        self._layout_is_stored = False
        files.delete_dir(self.spark, self.root)
