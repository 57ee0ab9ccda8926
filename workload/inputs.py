"""Inputs the queries derive from the driver's tables, in Spark and as SQL text.

Histories, merge batches, control rows and catalogs all grow with the tables they come from:
every user is a synced table of the CDC history, every customer a table of the catalog.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.coerce import ntz
from tablesync.plans.frames import small_frame

LO = datetime(1999, 1, 1)
HI = datetime(2000, 1, 1)
START = datetime(2024, 1, 2)
END = datetime(2024, 1, 3)
AS_OF = datetime(2024, 1, 30)
RUN_ID = "run_1"
CHECKED_AT = datetime(2024, 1, 30, 12)
SCHEMA = "public"

SQL_LO = "TIMESTAMP '1999-01-01 00:00:00'"
SQL_HI = "TIMESTAMP '2000-01-01 00:00:00'"
SQL_START = "TIMESTAMP '2024-01-02 00:00:00'"
SQL_END = "TIMESTAMP '2024-01-03 00:00:00'"
SQL_AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"
SQL_CHECKED_AT = "TIMESTAMP '2024-01-30 12:00:00'"
SQL_EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- merge: the target as it was at HI, the batch of everything since LO -----------------------

M_TGT = f"""m_tgt AS (
  SELECT o_orderkey, o_totalprice, CAST(NULL AS BOOLEAN) AS is_deleted
  FROM orders WHERE o_orderdate <= {SQL_HI})"""

M_STG = f"""m_stg AS (
  SELECT o_orderkey, o_totalprice + 1 AS o_totalprice,
         CASE o_orderstatus WHEN 'P' THEN true WHEN 'F' THEN false END AS is_deleted
  FROM orders WHERE o_orderdate > {SQL_LO})"""


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderdate") <= ntz(HI))
        .select("o_orderkey", "o_totalprice", F.lit(None).cast("boolean").alias("is_deleted"))
    )


def merge_batch(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") == "P", True).when(F.col("o_orderstatus") == "F", False)
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderdate") > ntz(LO))
        .select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), flag.alias("is_deleted"), *extra)
    )


# -- histories ---------------------------------------------------------------------------------

CDC_H = """cdc_h AS (
  SELECT concat('run_', CAST(event_id AS VARCHAR)) AS dag_run_id,
         CASE WHEN event_type = 'click' AND value < 1 THEN NULL ELSE concat('t', CAST(user_id AS VARCHAR)) END AS table_name,
         ts AS checked_at,
         CASE event_type WHEN 'error' THEN 'MISMATCH' WHEN 'signup' THEN 'failed' ELSE 'SUCCESS' END AS status,
         1000 + user_id AS source_row_count,
         1000 + user_id - CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS target_row_count,
         CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS row_count_diff,
         CAST(floor(value) AS BIGINT) AS cdc_row_count,
         ts AS last_watermark, ts AS last_cdc_run_at
  FROM events)"""

FULL_H = """full_h AS (
  SELECT concat('load_', CAST(o_orderkey AS VARCHAR)) AS run_id, 'FULL_LOAD' AS pipeline_type,
         concat('t', CAST(o_custkey AS VARCHAR)) AS table_name,
         o_orderdate AS start_time, o_orderdate + INTERVAL 1 HOUR AS end_time,
         CASE o_orderstatus WHEN 'P' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         1000 + o_custkey AS pg_count,
         1000 + o_custkey - CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS sf_count,
         CAST(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS BIGINT) AS count_diff
  FROM orders)"""


def cdc_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    differs = F.when(F.col("event_type") == "error", 1).otherwise(0).cast("bigint")
    count = F.lit(1000) + F.col("user_id")
    unnamed = (F.col("event_type") == "click") & (F.col("value") < 1)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run_"), F.col("event_id").cast("string")).alias("dag_run_id"),
        F.when(~unnamed, F.concat(F.lit("t"), F.col("user_id").cast("string"))).alias("table_name"),
        F.col("ts").alias("checked_at"),
        F.when(F.col("event_type") == "error", "MISMATCH")
        .when(F.col("event_type") == "signup", "failed")
        .otherwise("SUCCESS")
        .alias("status"),
        count.alias("source_row_count"),
        (count - differs).alias("target_row_count"),
        differs.alias("row_count_diff"),
        F.floor("value").alias("cdc_row_count"),
        F.col("ts").alias("last_watermark"),
        F.col("ts").alias("last_cdc_run_at"),
    )


def full_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("o_orderstatus") == "P"
    differs = F.when(failed, 1).otherwise(0).cast("bigint")
    count = F.lit(1000) + F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("load_"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.lit("FULL_LOAD").alias("pipeline_type"),
        F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("table_name"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).alias("end_time"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        count.alias("pg_count"),
        (count - differs).alias("sf_count"),
        differs.alias("count_diff"),
    )


# -- daily measures, and the same packed as columnar JSON documents of one week each -----------

DAILY = """daily AS (
  SELECT CAST(ts AS DATE) AS forecast_date, max(value) AS t_max, min(value) AS t_min
  FROM events GROUP BY CAST(ts AS DATE))"""
MEASURES = ("t_max", "t_min", "t_gap")  # the documents have no t_gap


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("forecast_date"))
        .agg(F.max("value").alias("t_max"), F.min("value").alias("t_min"))
    )


def forecast_documents(spark: SparkSession, sf_dir: str, since: date | None = None) -> DataFrame:
    """One JSON object of parallel arrays per week: at most seven positions each."""
    days_wanted = daily(spark, sf_dir)
    if since is not None:
        days_wanted = days_wanted.filter(F.col("forecast_date") >= F.lit(since))
    days = F.array_sort(F.collect_list(F.struct("forecast_date", "t_max", "t_min")))
    weeks = days_wanted.groupBy(F.date_trunc("week", "forecast_date").alias("week")).agg(days.alias("d"))
    held = F.struct(
        F.transform("d", lambda x: x["forecast_date"].cast("string")).alias("time"),
        F.transform("d", lambda x: x["t_max"]).alias("t_max"),
        F.transform("d", lambda x: x["t_min"]).alias("t_min"),
    )
    return weeks.select(F.to_json(F.struct(held.alias("daily"))).alias("payload"))


# -- a catalog in which every customer owns a table --------------------------------------------

# Table shapes by market segment, as (segment, schema, ordinal, column, type, key position or 0).
SHAPES = [
    ("BUILDING", "public", 1, "id", "bigint", 1),  # single key, cursor
    ("BUILDING", "public", 2, "updated_at", "timestamp without time zone", 0),
    ("AUTOMOBILE", "public", 1, "item_id", "integer", 2),  # composite key, flag
    ("AUTOMOBILE", "public", 2, "order_id", "bigint", 1),
    ("AUTOMOBILE", "public", 3, "is_deleted", "boolean", 0),
    ("AUTOMOBILE", "public", 4, "updated_at", "timestamp without time zone", 0),
    ("MACHINERY", "public", 1, "id", "bigint", 0),  # no key
    ("MACHINERY", "public", 2, "updated_at", "timestamp without time zone", 0),
    ("HOUSEHOLD", "public", 1, "id", "uuid", 1),  # no cursor
    ("HOUSEHOLD", "public", 2, "payload", "jsonb", 0),
    ("HOUSEHOLD", "audit", 1, "updated_at", "timestamp without time zone", 1),  # same name, other schema
    ("FURNITURE", "public", 1, "id", "bigint", 1),  # second-choice cursor, date flag
    ("FURNITURE", "public", 2, "last_modified", "timestamp with time zone", 0),
    ("FURNITURE", "public", 3, "modified_at", "timestamp without time zone", 0),
    ("FURNITURE", "public", 4, "deleted_at", "timestamp without time zone", 0),
]
_SHAPE_NAMES = "segment string, table_schema string, ordinal int, column_name string, data_type string, key_position int"

_VALUES = ", ".join(f"('{a}', '{b}', {c}, '{d}', '{e}', {f})" for a, b, c, d, e, f in SHAPES)
META = f"""shapes(segment, table_schema, ordinal, column_name, data_type, key_position) AS (VALUES {_VALUES}),
meta_columns AS (
  SELECT table_schema, concat('t', CAST(c_custkey AS VARCHAR)) AS table_name, column_name, data_type,
         ordinal AS ordinal_position
  FROM customer JOIN shapes ON c_mktsegment = segment),
meta_key_usage AS (
  SELECT table_schema, concat('t', CAST(c_custkey AS VARCHAR)) AS table_name,
         concat('pk_t', CAST(c_custkey AS VARCHAR)) AS constraint_name, column_name, key_position AS ordinal_position
  FROM customer JOIN shapes ON c_mktsegment = segment WHERE key_position > 0
  UNION ALL
  SELECT table_schema, concat('t', CAST(c_custkey AS VARCHAR)), concat('uq_t', CAST(c_custkey AS VARCHAR)), column_name, ordinal
  FROM customer JOIN shapes ON c_mktsegment = segment WHERE ordinal = 2),
meta_constraints AS (
  SELECT DISTINCT table_schema, table_name, constraint_name,
         CASE WHEN constraint_name LIKE 'pk_%' THEN 'PRIMARY KEY' ELSE 'UNIQUE' END AS constraint_type
  FROM meta_key_usage)"""


def _owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = small_frame(spark, SHAPES, T.StructType.fromDDL(_SHAPE_NAMES))  # the rows above, so small enough to broadcast
    return (
        table(spark, sf_dir, "customer")
        .join(F.broadcast(shapes), F.col("c_mktsegment") == F.col("segment"))
        .withColumn("table_name", F.concat(F.lit("t"), F.col("c_custkey").cast("string")))
    )


def meta_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _owned(spark, sf_dir).select(
        "table_schema", "table_name", "column_name", "data_type", F.col("ordinal").alias("ordinal_position")
    )


def meta_key_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    owned = _owned(spark, sf_dir)

    def used(rows: DataFrame, prefix: str, position: str) -> DataFrame:
        return rows.select(
            "table_schema",
            "table_name",
            F.concat(F.lit(prefix), F.col("table_name")).alias("constraint_name"),
            "column_name",
            F.col(position).alias("ordinal_position"),
        )

    return used(owned.filter("key_position > 0"), "pk_", "key_position").unionByName(
        used(owned.filter("ordinal = 2"), "uq_", "ordinal")
    )


def meta_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("constraint_name").startswith("pk_"), "PRIMARY KEY").otherwise("UNIQUE")
    return (
        meta_key_usage(spark, sf_dir)
        .select("table_schema", "table_name", "constraint_name")
        .distinct()
        .withColumn("constraint_type", kind)
    )


# -- control rows: one per customer ------------------------------------------------------------

ELIGIBLE = """eligible AS (
  SELECT concat('t', CAST(c_custkey AS VARCHAR)) AS table_name,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 'modified_at' ELSE 'updated_at' END AS updated_at_col,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'order_id,item_id' ELSE 'id' END AS pk_columns,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'is_deleted' WHEN 'FURNITURE' THEN 'deleted_at' END AS delete_flag_col
  FROM customer)"""

CONTROL = f"""control AS (
  SELECT e.table_name, e.updated_at_col, e.pk_columns, coalesce(e.delete_flag_col, '') AS delete_flag_col,
         o.last_watermark, o.last_watermark AS last_run_at
  FROM eligible e JOIN (
    SELECT concat('t', CAST(o_custkey AS VARCHAR)) AS table_name, max(o_orderdate) AS last_watermark
    FROM orders WHERE o_orderdate <= {SQL_LO} GROUP BY 1) o ON e.table_name = o.table_name)"""

BATCHES = f"""batches AS (
  SELECT concat('t', CAST(o_custkey AS VARCHAR)) AS table_name, count(*) AS row_count, max(o_orderdate) AS new_watermark
  FROM orders WHERE o_orderdate > {SQL_LO} AND o_orderdate <= {SQL_HI} GROUP BY 1)"""


def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("table_name"),
        F.when(segment == "FURNITURE", "modified_at").otherwise("updated_at").alias("updated_at_col"),
        F.when(segment == "AUTOMOBILE", F.array(F.lit("order_id"), F.lit("item_id")))
        .otherwise(F.array(F.lit("id")))
        .alias("pk_columns"),
        F.when(segment == "AUTOMOBILE", "is_deleted").when(segment == "FURNITURE", "deleted_at").alias("delete_flag_col"),
    )


def _per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("table_name")).agg(
        F.count("*").alias("row_count"), F.max("o_orderdate").alias("new_watermark")
    )


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") <= ntz(LO))
    stored = _per_customer(early).select("table_name", F.col("new_watermark").alias("last_watermark"))
    return eligible(spark, sf_dir).join(stored, "table_name").select(
        "table_name",
        "updated_at_col",
        F.concat_ws(",", "pk_columns").alias("pk_columns"),
        F.coalesce("delete_flag_col", F.lit("")).alias("delete_flag_col"),
        "last_watermark",
        F.col("last_watermark").alias("last_run_at"),
    )


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table: changed rows between the two bounds, and the newest of their cursors."""
    window = (F.col("o_orderdate") > ntz(LO)) & (F.col("o_orderdate") <= ntz(HI))
    return _per_customer(table(spark, sf_dir, "orders").filter(window))


# -- counts of both sides per table ------------------------------------------------------------

COUNTS = f"""src AS (SELECT concat('t', CAST(o_custkey AS VARCHAR)) AS table_name, count(*) AS row_count
  FROM orders WHERE o_orderdate > {SQL_LO} GROUP BY 1),
tgt AS (SELECT concat('t', CAST(o_custkey AS VARCHAR)) AS table_name, count(*) AS row_count
  FROM orders WHERE o_orderdate <= {SQL_HI} GROUP BY 1),
rec AS (SELECT table_name, coalesce(src.row_count, 0) AS source_count, coalesce(tgt.row_count, 0) AS target_count
  FROM src FULL OUTER JOIN tgt USING (table_name))"""


def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_customer(table(spark, sf_dir, "orders").filter(F.col("o_orderdate") > ntz(LO))).drop("new_watermark")


def target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_customer(table(spark, sf_dir, "orders").filter(F.col("o_orderdate") <= ntz(HI))).drop("new_watermark")
