"""Native source types to Spark types.

The schema of every staged table comes from source metadata, never from the data, so an
empty table or a column that starts with NULLs still gets its declared types.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Native type name -> Spark type name, per kind of source.
# "decimal" takes precision and scale from the source column.
POSTGRES_TYPES = {
    "smallint": "bigint",
    "integer": "bigint",
    "bigint": "bigint",
    "numeric": "decimal",
    "real": "double",
    "double precision": "double",
    "text": "string",
    "character varying": "string",
    "character": "string",
    "boolean": "boolean",
    "date": "date",
    "timestamp without time zone": "timestamp_ntz",
    "timestamp with time zone": "timestamp",
    "json": "variant",
    "jsonb": "variant",
    "uuid": "string",
}
MYSQL_TYPES = {
    "tinyint": "bigint",
    "smallint": "bigint",
    "mediumint": "bigint",
    "int": "bigint",
    "bigint": "bigint",
    "decimal": "decimal",
    "float": "double",
    "double": "double",
    "varchar": "string",
    "char": "string",
    "text": "string",
    "longtext": "string",
    "date": "date",
    "datetime": "timestamp_ntz",
    "timestamp": "timestamp_ntz",
    "json": "variant",
}
ORACLE_TYPES = {
    "NUMBER": "decimal",
    "FLOAT": "double",
    "VARCHAR2": "string",
    "NVARCHAR2": "string",
    "CHAR": "string",
    "CLOB": "string",
    "DATE": "timestamp_ntz",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP WITH TIME ZONE": "timestamp",
}

SPARK_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "timestamp": T.TimestampType(),
    "variant": T.VariantType(),
}

# Lookup is exact for Postgres and case-folded for the other two.
_MAPS = {
    "postgres": (POSTGRES_TYPES, str),
    "mysql": (MYSQL_TYPES, str.lower),
    "oracle": (ORACLE_TYPES, str.upper),
}

_PARENS = re.compile(r"\s*\([^)]*\)")

DEFAULT_DECIMAL = T.DecimalType(38, 18)


@dataclass(frozen=True)
class ColumnMeta:
    """One column of a source table, in ordinal order."""

    name: str
    native_type: str
    precision: int | None = None
    scale: int | None = None


def _decimal(precision: int | None, scale: int | None) -> T.DataType:
    """A negative scale widens the number by that many digits, and a scale beyond the precision makes it that wide.
    More than 38 digits are kept as text: no decimal type holds them."""
    if not precision:
        return DEFAULT_DECIMAL
    scale = int(scale or 0)
    width = max(int(precision) - min(scale, 0), scale)
    return T.DecimalType(width, max(scale, 0)) if width <= 38 else T.StringType()


def spark_type(kind: str, native: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Spark type of a native type name; anything unlisted is a string.

    Lake sources (``parquet``, ``catalog``) already carry Spark type names.
    """
    if kind not in _MAPS:
        return T.DataType.fromDDL(native)
    names, fold = _MAPS[kind]
    mapped = names.get(fold(_PARENS.sub("", native).strip()), "string")
    return _decimal(precision, scale) if mapped == "decimal" else SPARK_TYPES[mapped]


def mapped_schema(kind: str, columns: Iterable[ColumnMeta]) -> T.StructType:
    """Target schema of a source table. A table without columns is an error."""
    fields = [
        T.StructField(c.name, spark_type(kind, c.native_type, c.precision, c.scale), True) for c in columns
    ]
    if not fields:
        raise ValueError("source table has no columns")
    return T.StructType(fields)


def by_folded_name(names: Iterable[str]) -> dict[str, str]:
    """Lower-cased name -> actual name; two columns that differ only in case are refused."""
    folded: dict[str, str] = {}
    for name in names:
        if name.lower() in folded:
            raise ValueError(f"ambiguous column name {name!r}")
        folded[name.lower()] = name
    return folded


def typed(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast one column, parsing text where the target is a variant."""
    if have == want:
        return column
    if isinstance(want, T.VariantType):
        return F.parse_json(column.cast("string"))
    return column.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema`` by case-insensitive name: missing columns become typed NULLs,
    extra columns are dropped, types are cast."""
    have = by_folded_name(df.columns)
    out = []
    for field in schema.fields:
        actual = have.get(field.name.lower())
        if actual is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = typed(df[f"`{actual}`"], df.schema[actual].dataType, field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)


def ddl_columns(schema: T.StructType) -> str:
    """Column list of a CREATE TABLE statement."""
    return ", ".join(
        "`{}` {}".format(f.name.replace("`", "``"), f.dataType.simpleString()) for f in schema.fields
    )
