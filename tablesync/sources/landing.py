"""Columnar JSON landed as files: one object of parallel arrays per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The measures of the daily forecast, in column order.
FORECAST_MEASURES = (
    "temperature_2m_max",
    "temperature_2m_min",
    "precipitation_sum",
    "precipitation_probability_max",
    "windspeed_10m_max",
)


def columnar_schema(measures: Sequence[str], axis: str = "time", holder: str = "daily") -> T.StructType:
    arrays = [T.StructField(axis, T.ArrayType(T.StringType()))]
    arrays += [T.StructField(m, T.ArrayType(T.DoubleType())) for m in measures]
    return T.StructType([T.StructField(holder, T.StructType(arrays))])


def read_landing(spark: SparkSession, path: str, measures: Sequence[str]) -> DataFrame:
    """Landed documents with a declared schema: nothing is inferred, missing arrays read as NULL."""
    return spark.read.schema(columnar_schema(measures)).option("multiLine", "true").json(path)


def parse_columnar(df: DataFrame, text: str, measures: Sequence[str]) -> DataFrame:
    """The same documents held as JSON text in a column."""
    parsed = F.from_json(F.col(text), columnar_schema(measures), {"mode": "FAILFAST"})
    return df.withColumn("daily", parsed["daily"])


def _checked(array: Column, axis: Column, name: str) -> Column:
    return F.when(
        array.isNotNull() & (F.size(array) != F.size(axis)),
        F.raise_error(F.lit(f"array {name} differs in length from the time axis")),
    ).otherwise(F.coalesce(array, F.array().cast("array<double>")))


def columnar_rows(
    df: DataFrame,
    measures: Sequence[str],
    date_column: str = "forecast_date",
    axis: str = "time",
    holder: str = "daily",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per position of the parallel arrays.

    A document without the object or without its time axis is an error; a missing measure gives a
    NULL column. The arrays of a document are as long as its forecast, so the zip stays small.
    """
    times = F.col(f"{holder}.{axis}")
    times = F.when(times.isNull(), F.raise_error(F.lit(f"document has no {holder}.{axis}"))).otherwise(times)
    zipped = F.arrays_zip(
        times.alias(axis),
        *[_checked(F.col(f"{holder}.{m}"), F.col(f"{holder}.{axis}"), m).alias(m) for m in measures],
    )
    rows = df.select(*keep, F.inline(zipped.cast(_zip_type(measures, axis))))
    return rows.select(
        *keep,
        F.to_date(F.col(axis)).alias(date_column),
        *[F.col(m).cast("double").alias(m) for m in measures],
    )


def _zip_type(measures: Sequence[str], axis: str) -> T.ArrayType:
    fields = [T.StructField(axis, T.StringType())]
    fields += [T.StructField(m, T.DoubleType()) for m in measures]
    return T.ArrayType(T.StructType(fields))


def from_variant(df: DataFrame, column: str, fields: dict[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Path extract and cast from a semi-structured column.

    ``fields`` maps an output name to (path, type); text columns are parsed once per row.
    """
    parsed = df
    if not isinstance(df.schema[column].dataType, T.VariantType):
        parsed = df.withColumn(column, F.parse_json(F.col(column)))
    return parsed.select(
        *keep, *[F.variant_get(F.col(column), path, kind).alias(name) for name, (path, kind) in fields.items()]
    )
