"""Cursor control rows: lookup, initialise, advance."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.coerce import ntz
from tablesync.operators.extract import DEFAULT_WATERMARK

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("updated_at_col", T.StringType()),
        T.StructField("pk_columns", T.StringType()),
        T.StructField("delete_flag_col", T.StringType()),
        T.StructField("last_watermark", T.TimestampNTZType()),
        T.StructField("last_run_at", T.TimestampNTZType()),
    ]
)

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("last_updated_at", T.TimestampNTZType()),
        T.StructField("updated_by_run", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)


#: Whose table a row is about; '' or absent for a single source. With the exact table name it is the row's identity.
SOURCE_NAME = T.StructField("source_name", T.StringType())

_SOURCE, _FOLDED = "_source", "_folded"
_GROUP = [_SOURCE, _FOLDED]


def control_name(source: str, table: str) -> str:
    """A table's name in reports: sources that share a table name have rows of their own."""
    return f"{source}.{table}".lower() if source else table.lower()


def _grouped(df: DataFrame) -> DataFrame:
    """With source and lower-case name. Names are matched exactly; where a spelling is not stored, another one of the same source and
    letters stands in for it, because catalogs differ in case."""
    source = F.coalesce("source_name", F.lit("")) if "source_name" in df.columns else F.lit("")
    return df.withColumns({_SOURCE: source, _FOLDED: F.lower("table_name")})


def _spellings(df: DataFrame, *columns: Column) -> DataFrame:
    """One row per source and lower-case name, with all its spellings: a list as long as there are spellings."""
    return _grouped(df).groupBy(*_GROUP).agg(F.collect_list(F.struct(F.col("table_name").alias("name"), *columns)).alias("came"))


def _kept(df: DataFrame) -> list[str]:
    return [c for c in ("source_name", "table_name") if c in df.columns]


def _named(rows: Column, name: Column) -> Column:
    return F.filter(rows, lambda r: r["name"] == name)


def _unnamed(rows: Column, names: Column) -> Column:
    return F.filter(rows, lambda r: ~F.array_contains(names, r["name"]))


def lookup_watermarks(tables: DataFrame, control: DataFrame, stored: str = "last_watermark") -> DataFrame:
    """Cursor per table, the default where none is stored: that of the exact name, else the oldest of its other spellings, so
    nothing is left out."""
    known = _spellings(control, F.col(stored).alias("at"))
    exact = F.array_min(F.transform(_named(F.col("came"), F.col("table_name")), lambda r: r["at"]))
    oldest = F.array_min(F.transform("came", lambda r: r["at"]))
    return (
        _grouped(tables.select(*_kept(tables)))
        .join(known, _GROUP, "left")
        .select(*_kept(tables), F.coalesce(exact, oldest, ntz(DEFAULT_WATERMARK)).alias("watermark"))
    )


def new_control_rows(eligible: DataFrame, control: DataFrame) -> DataFrame:
    """Initial rows of eligible tables that have none: key joined by commas, '' for no flag. A stored name that is not eligible itself
    counts for another spelling of it."""
    wanted = _grouped(eligible)
    spelled = F.collect_set("table_name").over(Window.partitionBy(*_GROUP))
    name, names = F.col("table_name"), F.transform("came", lambda r: r["name"])
    has_one = F.array_contains(names, name) | (F.size(F.array_except(names, F.col("_spelled"))) > 0)
    found = wanted.withColumn("_spelled", spelled).join(_spellings(control), _GROUP, "left")
    columns = [c for c in ("source_name",) if c in control.columns]
    return found.where(~F.coalesce(has_one, F.lit(False))).select(
        *(F.col(_SOURCE).alias(c) for c in columns),
        "table_name",
        "updated_at_col",
        F.concat_ws(",", "pk_columns").alias("pk_columns"),
        F.coalesce("delete_flag_col", F.lit("")).alias("delete_flag_col"),
        ntz(DEFAULT_WATERMARK).alias("last_watermark"),
        F.lit(None).cast("timestamp_ntz").alias("last_run_at"),
    )


def init_control(control: DataFrame, eligible: DataFrame) -> DataFrame:
    return control.unionByName(new_control_rows(eligible, control))


def advance(control: DataFrame, results: DataFrame, run_at: datetime) -> DataFrame:
    """Control after successful merges. ``results`` is (source_name, table_name, new_watermark); tables without changes bring their
    old cursor and only get a new run time. Unknown tables are not added: this is an update. Results are gathered by
    name before the join, so there are as many rows after it as before."""
    ran = _spellings(results, F.col("new_watermark").alias("at"))
    spelled = F.collect_set("table_name").over(Window.partitionBy(*_GROUP))
    exact = _named(F.col("came"), F.col("table_name"))
    found = F.when(F.size(exact) > 0, exact).otherwise(_unnamed(F.col("came"), F.col("_spelled")))
    is_mine = F.coalesce(F.size("_found") > 0, F.lit(False))
    newest = F.array_max(F.transform("_found", lambda r: r["at"]))
    return (
        _grouped(control)
        .withColumn("_spelled", spelled)
        .join(ran, _GROUP, "left")
        .withColumn("_found", found)
        .withColumns(
            {
                "last_watermark": F.when(is_mine, newest).otherwise(F.col("last_watermark")),
                "last_run_at": F.when(is_mine, ntz(run_at)).otherwise(F.col("last_run_at")),
            }
        )
        .select(*control.columns)
    )


def upsert_watermarks(stored: DataFrame, batches: DataFrame, run_id: str, now: datetime) -> DataFrame:
    """Cursor upsert for all tables of a run in one job. An update also stamps the audit time; an
    insert leaves it NULL."""
    fields = ("last_updated_at", "updated_by_run", "updated_at")
    old = _spellings(stored, *(F.col(f) for f in fields)).withColumnRenamed("came", "_old")
    new = _spellings(batches, F.col("max_updated_at").cast("timestamp_ntz").alias("at"))
    none = F.array()
    both = old.join(new, _GROUP, "full_outer").withColumns({"_old": F.coalesce("_old", none), "came": F.coalesce("came", none)})
    known, brought = F.transform("_old", lambda r: r["name"]), F.transform("came", lambda r: r["name"])
    stranger = _unnamed(F.col("came"), known)
    newest = lambda rows: F.array_max(F.transform(rows, lambda r: r["at"]))

    def row(name: Column, last: Column, run: Column, at: Column) -> Column:
        return F.struct(name.alias("table_name"), *(v.alias(f) for v, f in zip((last, run, at), fields)))

    def updated(r: Column) -> Column:
        own = _named(F.col("came"), r["name"])
        mine = F.when(F.size(own) > 0, own).otherwise(stranger)
        moved = row(r["name"], newest(mine), F.lit(run_id), ntz(now))
        return F.when(F.size(mine) > 0, moved).otherwise(row(r["name"], *(r[f] for f in fields)))

    nothing = F.lit(None).cast("timestamp_ntz")
    stands_in = F.size(F.array_except(known, brought)) > 0
    inserted = F.when(~stands_in, F.transform(stranger, lambda c: row(c["name"], c["at"], F.lit(run_id), nothing)))
    rows = F.explode(F.concat(F.transform("_old", updated), F.coalesce(inserted, F.array()))).alias("row")
    source = [F.col(_SOURCE).alias("source_name")] if "source_name" in stored.columns else []
    return both.select(*source, rows).select(*(["source_name"] if source else []), "row.*").select(*stored.columns)


def pair_results(configs: DataFrame, results: DataFrame) -> DataFrame:
    """Each table's configuration beside its result, paired by name rather than by position."""
    return configs.join(results, "table_name", "inner")


def sync_tally(batches: DataFrame) -> DataFrame:
    """One row: how many tables a run synced, and their names.

    The list is as long as the catalog, not as the data: tables are made distinct, and so
    pre-aggregated before the shuffle, before they are listed.
    """
    names = batches.select("table_name").distinct()
    return names.agg(
        F.count("*").alias("synced_tables"),
        F.array_join(F.array_sort(F.collect_list("table_name")), ",").alias("table_names"),
    )
