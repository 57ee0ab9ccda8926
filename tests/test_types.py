"""Type map, by-name projection, naming and tolerant casts."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions import coerce
from tablesync.functions.naming import qualified, quote, path_safe, target_name
from tablesync.functions.status import LABEL_FAILED, LABEL_MISMATCH, LABEL_OK, display_status
from tablesync.functions.typemap import (
    MYSQL_TYPES,
    ORACLE_TYPES,
    POSTGRES_TYPES,
    ColumnMeta,
    conform,
    mapped_schema,
    spark_type,
)


@pytest.mark.parametrize(
    ("kind", "names"), [("postgres", POSTGRES_TYPES), ("mysql", MYSQL_TYPES), ("oracle", ORACLE_TYPES)]
)
def test_every_listed_type_maps(kind, names):
    for native, spark_name in names.items():
        want = T.DecimalType(38, 18) if spark_name == "decimal" else T.DataType.fromDDL(spark_name)
        assert spark_type(kind, native) == want


def test_map_sizes():
    assert (len(POSTGRES_TYPES), len(MYSQL_TYPES), len(ORACLE_TYPES)) == (16, 16, 9)


@pytest.mark.parametrize(
    ("kind", "native", "want"),
    [
        ("postgres", "character varying(20)", "string"),
        ("postgres", "INTEGER", "string"),  # exact lookup
        ("postgres", "bytea", "string"),
        ("mysql", "BIGINT(20)", "bigint"),
        ("mysql", "blob", "string"),
        ("oracle", "varchar2", "string"),
        ("oracle", "TIMESTAMP(6)", "timestamp_ntz"),
        ("oracle", "timestamp(6) with time zone", "timestamp"),
        ("oracle", "date", "timestamp_ntz"),
        ("parquet", "array<int>", "array<int>"),
    ],
)
def test_fallback_and_folding(kind, native, want):
    assert spark_type(kind, native) == T.DataType.fromDDL(want)


@pytest.mark.parametrize(
    ("precision", "scale", "want"),
    [(12, 2, (12, 2)), (None, None, (38, 18)), (60, 4, None), (10, None, (10, 0)), (10, -2, (12, 0)), (50, 10, None), (3, 5, (5, 5)), (37, -2, None)],
)
def test_decimal_keeps_precision(precision, scale, want):
    assert spark_type("postgres", "numeric", precision, scale) == (T.DecimalType(*want) if want else T.StringType())


def test_table_without_columns_is_refused():
    with pytest.raises(ValueError, match="no columns"):
        mapped_schema("postgres", [])


def test_conform_by_name(spark):
    schema = mapped_schema(
        "postgres", [ColumnMeta("id", "bigint"), ColumnMeta("doc", "jsonb"), ColumnMeta("at", "date"), ColumnMeta("gone", "text")]
    )
    df = spark.createDataFrame([("7", '{"a": 1}', "2024-01-02", "x")], "ID string, Doc string, at string, extra string")
    out = conform(df, schema)
    assert out.columns == ["id", "doc", "at", "gone"]
    row = out.select("id", F.to_json("doc").alias("doc"), F.col("at").cast("string"), "gone").first()
    assert tuple(row) == (7, '{"a":1}', "2024-01-02", None)


def test_conform_refuses_ambiguous_names(spark):
    df = spark.range(1).select(F.col("id").alias("a"), F.col("id").alias("A"))
    with pytest.raises(ValueError, match="ambiguous"):
        conform(df, T.StructType([T.StructField("a", T.LongType())]))


def test_naming():
    assert quote("postgres", 'we"ird') == '"we""ird"'
    assert quote("mysql", "we`ird") == "`we``ird`"
    assert qualified("oracle", "ERP", "T") == '"ERP"."T"'
    assert target_name("crm", "users") == "crm_users"
    assert path_safe("run 2024-01-01T00:00:00+00:00") == "run+2024-01-01T00_3A00_3A00_2B00_3A00"


@pytest.mark.parametrize(
    ("text", "want"),
    [("12", 12.0), (" 1.5 ", 1.5), ("n/a", 0.0), (None, 0.0), ("NaN", 0.0), ("1d", 0.0), ("2f", 0.0), ("", 0.0), ("-3e2", -300.0)],
)
def test_numeric_or_zero(spark, text, want):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(coerce.numeric_or_zero(F.col("c"))).first()[0] == want


def test_timestamp_or_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05.678901",), ("soon",), (None,)], "c string")
    got = [r[0] for r in df.select(coerce.timestamp_or_null(F.col("c"))).collect()]
    assert got == [datetime(2024, 1, 2, 3, 4, 5, 678901), None, None]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2024-01-02T00:00:00+09:00", datetime(2024, 1, 1, 15)),
        ("2024-01-02T00:00:00Z", datetime(2024, 1, 2)),
        ("2024-01-02 00:00:00", datetime(2024, 1, 2)),
    ],
)
def test_bounds_are_normalised_once(text, want):
    assert coerce.utc_naive(text) == want


@pytest.mark.parametrize(
    ("status", "diff", "want"),
    [
        ("FAILED", "0", LABEL_FAILED),
        ("failed", "5", LABEL_FAILED),
        ("SUCCESS", "1", LABEL_MISMATCH),
        ("SUCCESS", "0", LABEL_OK),
        ("SUCCESS", "what", LABEL_OK),
        (None, None, LABEL_OK),
        (None, "2", LABEL_MISMATCH),
    ],
)
def test_display_status(spark, status, diff, want):
    df = spark.createDataFrame([(status, diff)], "s string, d string")
    assert df.select(display_status(F.col("s"), F.col("d"))).first()[0] == want
