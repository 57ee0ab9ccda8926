"""Discovery over metadata frames: columns, keys, eligibility for change sync.

All tables of a source are handled in one job instead of three catalog queries per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.extract import CURSOR_CANDIDATES, DELETE_FLAG_CANDIDATES


def table_columns(columns: DataFrame, schema: str) -> DataFrame:
    """Columns of one schema in ordinal order. Always schema-qualified, so equally named tables of
    other schemas do not mix in."""
    return (
        columns.filter(F.col("table_schema") == schema)
        .select("table_name", "ordinal_position", "column_name", "data_type")
        .orderBy("table_name", "ordinal_position")
    )


def pk_columns(constraints: DataFrame, key_usage: DataFrame, schema: str) -> DataFrame:
    """Ordered list of key columns per table; composite keys keep all their columns."""
    on = ["table_schema", "constraint_name"]
    if "table_name" in key_usage.columns:
        on.append("table_name")
    primary = constraints.filter(
        (F.col("table_schema") == schema) & (F.col("constraint_type") == "PRIMARY KEY")
    )
    used = primary.join(key_usage, on, "inner")
    parts = F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name")))
    return used.groupBy("table_name").agg(F.transform(parts, lambda p: p["column_name"]).alias("pk_columns"))


def _first_present(candidates: Sequence[str]) -> Column:
    """First candidate a table has, by order of preference, under the name the table gives it. Catalogs differ in
    case, so names are compared in lower case."""
    present = [F.min(F.when(F.lower("column_name") == c, F.col("column_name"))) for c in candidates]
    return F.coalesce(*present)


def change_columns(columns: DataFrame, schema: str) -> DataFrame:
    """Cursor and delete-flag column per table, NULL where it has none."""
    return (
        columns.filter(F.col("table_schema") == schema)
        .groupBy("table_name")
        .agg(
            _first_present(CURSOR_CANDIDATES).alias("updated_at_col"),
            _first_present(DELETE_FLAG_CANDIDATES).alias("delete_flag_col"),
        )
    )


def cdc_eligible(columns: DataFrame, constraints: DataFrame, key_usage: DataFrame, schema: str) -> DataFrame:
    """Tables with a primary key and a cursor column."""
    tracked = change_columns(columns, schema).filter(F.col("updated_at_col").isNotNull())
    return tracked.join(pk_columns(constraints, key_usage, schema), "table_name", "inner")


def missing_columns(source: DataFrame, target: DataFrame) -> list[str]:
    """Source columns the target lacks, compared without case."""
    have = {c.lower() for c in target.columns}
    return [c for c in source.columns if c.lower() not in have]


def evolve(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target with the source's extra columns added, NULL in the rows it already has."""
    return target.withColumns(
        {c: F.lit(None).cast(source.schema[c].dataType) for c in missing_columns(source, target)}
    )
