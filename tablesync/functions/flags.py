"""Soft-delete flags under three-valued logic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def delete_condition(df: DataFrame, flag: str | None) -> Column:
    """True where the row marks a delete.

    Booleans are compared as they are and stay NULL when NULL; a date or timestamp flag is set
    when present; text and numbers are read as booleans where they can be.
    """
    if flag is None:
        return F.lit(False)
    column = F.col(f"`{flag}`")
    kind = df.select(column).schema[0].dataType  # resolved by Spark, so case does not matter
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return column.isNotNull()
    if isinstance(kind, T.BooleanType):
        return column == F.lit(True)
    return column.try_cast("boolean") == F.lit(True)


def active_condition(df: DataFrame, flag: str | None) -> Column:
    """``NOT (flag = TRUE)``: NULL for a NULL flag, so such a row is neither deleted nor active."""
    return ~delete_condition(df, flag)


def is_live(df: DataFrame, flag: str | None) -> Column:
    """Rows that survive a merge: flag FALSE or NULL."""
    return ~F.coalesce(delete_condition(df, flag), F.lit(False))
