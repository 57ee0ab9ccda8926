"""Tolerant casts, time-zone normalisation and audit columns."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_or_zero(column: Column) -> Column:
    """Numbers as double; NULL, NaN and text that is not a number become 0."""
    # Java's parser would take "1d" and "2f" as numbers; "inf" is the one such suffix to keep.
    text = F.trim(column.cast("string"))
    suffixed = text.rlike("[0-9.][dDfF]$")
    value = F.when(~suffixed, text.try_cast("double"))
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(0.0))


def number_or_zero(df: DataFrame, name: str) -> Column:
    """Like ``numeric_or_zero``, but a column that is numeric already stays as it is."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.IntegralType, T.DecimalType)):
        return F.coalesce(column, F.lit(0))
    if isinstance(df.schema[name].dataType, T.FractionalType):
        return F.coalesce(F.nanvl(column, F.lit(None).cast("double")), F.lit(0.0))
    return numeric_or_zero(column)


def timestamp_or_null(column: Column) -> Column:
    """Zone-less timestamp; text that is not a timestamp becomes NULL."""
    return column.try_cast("timestamp_ntz")


def truncate_to_microseconds(df: DataFrame, columns: list[str]) -> DataFrame:
    """Spark timestamps carry microseconds, so the cast to a zone-less timestamp is the truncation."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def utc_naive(moment: datetime | str) -> datetime:
    """One normalisation of an interval or cursor bound: offset applied, then dropped.

    Casting offset text straight to ``timestamp_ntz`` would drop the offset without applying it.
    """
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment.replace("Z", "+00:00"))
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def ntz(moment: datetime | str) -> Column:
    """A zone-less timestamp literal, pushed down to Parquet and JDBC scans."""
    return F.lit(utc_naive(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def with_audit(df: DataFrame, **values: object) -> DataFrame:
    """Append constant audit columns (run id, load time, kind of run). Times are arguments, so a
    repeated run gives the same rows."""
    return df.withColumns(
        {k: ntz(v) if isinstance(v, datetime) else F.lit(v) for k, v in values.items()}
    )


def scaled(df: DataFrame, column: str, factor: float | int) -> DataFrame:
    return df.withColumn(column, F.col(column) * F.lit(factor))
