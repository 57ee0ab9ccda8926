"""Scans, projections, metadata and control queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.coerce import scaled, truncate_to_microseconds, with_audit
from tablesync.functions.typemap import ColumnMeta, conform, mapped_schema
from tablesync.operators import control as ctl
from tablesync.operators import metadata
from tablesync.operators.extract import project, rename_by_position
from tablesync.operators.merge import merge, MergeSpec
from tablesync.operators.quality import batch_profile, freshness
from tablesync.operators.reconcile import row_counts
from tablesync.sources.landing import columnar_rows, from_variant, parse_columnar
from workload import inputs as i
from workload.registry import query

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query("full_scan", "SELECT * FROM lineitem")
def full_scan(spark: SparkSession, sf: str) -> DataFrame:
    return i.table(spark, sf, "lineitem")


@query(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
)
def count_tables(spark: SparkSession, sf: str) -> DataFrame:
    return row_counts({t: i.table(spark, sf, t) for t in TABLES})


@query("project_columns", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem")
def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return project(i.table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_extendedprice"])


@query("positional_rename", "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def positional_rename(spark: SparkSession, sf: str) -> DataFrame:
    return rename_by_position(i.table(spark, sf, "customer"), ["id", "name", "nation", "balance", "segment"])


LINEITEM_META = [
    ColumnMeta("l_orderkey", "bigint"),
    ColumnMeta("l_linenumber", "integer"),
    ColumnMeta("l_quantity", "numeric", 12, 2),
    ColumnMeta("l_extendedprice", "double precision"),
    ColumnMeta("l_returnflag", "character(1)"),
    ColumnMeta("l_shipdate", "timestamp without time zone"),
    ColumnMeta("l_partkey", "unlisted type"),
]


@query(
    "type_mapped_cast",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity,
    l_extendedprice, l_returnflag, l_shipdate, CAST(l_partkey AS VARCHAR) AS l_partkey FROM lineitem""",
)
def type_mapped_cast(spark: SparkSession, sf: str) -> DataFrame:
    return conform(i.table(spark, sf, "lineitem"), mapped_schema("postgres", LINEITEM_META))


@query("truncate_us", "SELECT event_id, ts FROM events")
def truncate_us(spark: SparkSession, sf: str) -> DataFrame:
    return truncate_to_microseconds(i.table(spark, sf, "events").select("event_id", "ts"), ["ts"])


@query(
    "staged_by_name",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
    FROM orders""",
)
def staged_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """The staged side has other case, other order, one column missing and one too many."""
    orders = i.table(spark, sf, "orders")
    staged = orders.select(
        F.col("o_orderdate").alias("O_ORDERDATE"),
        F.col("o_totalprice").alias("O_TotalPrice"),
        F.col("o_orderkey").alias("O_ORDERKEY"),
        F.lit("x").alias("unknown_column"),
        F.col("o_custkey").alias("O_CUSTKEY"),
        F.col("o_orderstatus").alias("O_ORDERSTATUS"),
    )
    return conform(staged, orders.schema)


@query(
    "json_path_cast",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS DOUBLE) AS k_double,
    CAST(json_extract(props, '$.absent') AS BIGINT) AS absent FROM events""",
)
def json_path_cast(spark: SparkSession, sf: str) -> DataFrame:
    fields = {"k": ("$.k", "bigint"), "k_double": ("$.k", "double"), "absent": ("$.absent", "bigint")}
    return from_variant(i.table(spark, sf, "events"), "props", fields, keep=["event_id"])


@query("forecast_rows", f"WITH {i.DAILY} SELECT forecast_date, t_max, t_min, CAST(NULL AS DOUBLE) AS t_gap FROM daily")
def forecast_rows(spark: SparkSession, sf: str) -> DataFrame:
    return columnar_rows(parse_columnar(i.forecast_documents(spark, sf), "payload", i.MEASURES), i.MEASURES)


@query(
    "forecast_merge",
    f"""WITH {i.DAILY},
    kept AS (SELECT forecast_date, t_max + 1 AS t_max, t_min, t_min AS t_gap, {i.SQL_START} AS loaded_at FROM daily),
    docs AS (SELECT forecast_date, t_max, t_min, CAST(NULL AS DOUBLE) AS t_gap, {i.SQL_AS_OF} AS loaded_at FROM daily
      WHERE forecast_date >= DATE '2024-01-10')
    SELECT * FROM docs UNION ALL
    SELECT * FROM kept WHERE forecast_date < DATE '2024-01-20' AND forecast_date NOT IN (SELECT forecast_date FROM docs)""",
)
def forecast_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Documents from the tenth on, over a target that holds stale values up to the twentieth."""
    documents = i.forecast_documents(spark, sf, since=date(2024, 1, 10))
    rows = columnar_rows(parse_columnar(documents, "payload", i.MEASURES), i.MEASURES)
    stale = i.daily(spark, sf).filter(F.col("forecast_date") < F.lit(date(2024, 1, 20)))
    target = with_audit(
        stale.select("forecast_date", (F.col("t_max") + 1).alias("t_max"), "t_min", F.col("t_min").alias("t_gap")),
        loaded_at=i.START,
    )
    return merge(target, with_audit(rows, loaded_at=i.AS_OF), MergeSpec(("forecast_date",)))


@query(
    "freshness",
    "SELECT count(*) AS fresh_rows, count(*) > 0 AS is_fresh FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-30'",
)
def fresh(spark: SparkSession, sf: str) -> DataFrame:
    days = i.table(spark, sf, "events").select(F.to_date("ts").alias("day"))
    return freshness(days, "day", i.AS_OF.date())


@query(
    "batch_profile",
    "SELECT count(*) AS row_count, min(o_orderdate) AS min_value, max(o_orderdate) AS max_value FROM orders",
)
def profile(spark: SparkSession, sf: str) -> DataFrame:
    return batch_profile(i.table(spark, sf, "orders"), "o_orderdate")


@query(
    "audit_columns",
    f"SELECT o_orderkey, 'run_1' AS run_id, 'FULL_LOAD' AS pipeline_type, {i.SQL_CHECKED_AT} AS loaded_at FROM orders",
)
def audit(spark: SparkSession, sf: str) -> DataFrame:
    orders = i.table(spark, sf, "orders").select("o_orderkey")
    return with_audit(orders, run_id=i.RUN_ID, pipeline_type="FULL_LOAD", loaded_at=i.CHECKED_AT)


@query("scale_value", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * 2 AS l_quantity FROM lineitem")
def scale_value(spark: SparkSession, sf: str) -> DataFrame:
    rows = i.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return scaled(rows, "l_quantity", 2)


# -- metadata ----------------------------------------------------------------------------------


@query(
    "table_columns",
    f"WITH {i.META} SELECT table_name, ordinal_position, column_name, data_type FROM meta_columns WHERE table_schema = 'public'",
)
def columns_of_schema(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.table_columns(i.meta_columns(spark, sf), i.SCHEMA)


_PK = """pk AS (
  SELECT c.table_name, string_agg(k.column_name, ',' ORDER BY k.ordinal_position) AS pk_columns
  FROM meta_constraints c JOIN meta_key_usage k
    ON c.constraint_name = k.constraint_name AND c.table_schema = k.table_schema AND c.table_name = k.table_name
  WHERE c.table_schema = 'public' AND c.constraint_type = 'PRIMARY KEY' GROUP BY c.table_name)"""


@query("pk_columns", f"WITH {i.META}, {_PK} SELECT table_name, pk_columns FROM pk")
def keys_of_tables(spark: SparkSession, sf: str) -> DataFrame:
    keys = metadata.pk_columns(i.meta_constraints(spark, sf), i.meta_key_usage(spark, sf), i.SCHEMA)
    return keys.withColumn("pk_columns", F.concat_ws(",", "pk_columns"))


def _first(candidates: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN bool_or(column_name = '{c}') THEN '{c}'" for c in candidates)
    return f"CASE {cases} END"


@query(
    "cdc_eligible",
    f"""WITH {i.META}, {_PK}, tracked AS (
      SELECT table_name, {_first(metadata.CURSOR_CANDIDATES)} AS updated_at_col,
             {_first(metadata.DELETE_FLAG_CANDIDATES)} AS delete_flag_col
      FROM meta_columns WHERE table_schema = 'public' GROUP BY table_name)
    SELECT table_name, updated_at_col, delete_flag_col, pk_columns FROM tracked JOIN pk USING (table_name)
    WHERE updated_at_col IS NOT NULL""",
)
def eligible_tables(spark: SparkSession, sf: str) -> DataFrame:
    found = metadata.cdc_eligible(
        i.meta_columns(spark, sf), i.meta_constraints(spark, sf), i.meta_key_usage(spark, sf), i.SCHEMA
    )
    return found.withColumn("pk_columns", F.concat_ws(",", "pk_columns"))


# -- control -----------------------------------------------------------------------------------


@query(
    "watermarks",
    f"""WITH {i.ELIGIBLE}, {i.CONTROL}
    SELECT e.table_name, coalesce(c.last_watermark, {i.SQL_EPOCH}) AS watermark
    FROM eligible e LEFT JOIN control c ON e.table_name = c.table_name""",
)
def watermarks(spark: SparkSession, sf: str) -> DataFrame:
    stored = i.control(spark, sf).withColumn("table_name", F.upper("table_name"))
    return ctl.lookup_watermarks(i.eligible(spark, sf), stored)


@query(
    "watermarks_many_sources",
    f"""WITH {i.ELIGIBLE}, {i.CONTROL}, s AS (SELECT unnest(['crm', 'shop']) AS source)
    SELECT lower(s.source || '.' || e.table_name) AS table_name,
           CASE WHEN s.source = 'crm' THEN coalesce(c.last_watermark, {i.SQL_EPOCH}) ELSE {i.SQL_EPOCH} END AS watermark
    FROM eligible e CROSS JOIN s LEFT JOIN control c ON e.table_name = c.table_name""",
)
def watermarks_many_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources have tables of the same names; only the first one's, in another case, have a stored cursor."""
    stored = i.control(spark, sf).withColumn("table_name", F.concat(F.lit("CRM."), F.upper("table_name")))
    named = F.explode(F.transform(F.array(F.lit("crm"), F.lit("shop")), lambda s: F.concat(s, F.lit("."), F.col("table_name"))))
    return ctl.lookup_watermarks(i.eligible(spark, sf).select(named.alias("table_name")), stored)


@query(
    "control_init",
    f"""WITH {i.ELIGIBLE}, {i.CONTROL} SELECT * FROM control UNION ALL
    SELECT table_name, updated_at_col, pk_columns, coalesce(delete_flag_col, ''), {i.SQL_EPOCH}, CAST(NULL AS TIMESTAMP)
    FROM eligible WHERE table_name NOT IN (SELECT table_name FROM control)""",
)
def control_init(spark: SparkSession, sf: str) -> DataFrame:
    return ctl.init_control(i.control(spark, sf), i.eligible(spark, sf))


@query(
    "watermark_advance",
    f"""WITH {i.ELIGIBLE}, {i.CONTROL}, {i.BATCHES}
    SELECT c.table_name, c.updated_at_col, c.pk_columns, c.delete_flag_col,
           CASE WHEN b.table_name IS NULL THEN c.last_watermark ELSE b.new_watermark END AS last_watermark,
           CASE WHEN b.table_name IS NULL THEN c.last_run_at ELSE {i.SQL_CHECKED_AT} END AS last_run_at
    FROM control c LEFT JOIN batches b ON c.table_name = b.table_name""",
)
def watermark_advance(spark: SparkSession, sf: str) -> DataFrame:
    return ctl.advance(i.control(spark, sf), i.batches(spark, sf), i.CHECKED_AT)


@query(
    "watermark_upsert",
    f"""WITH {i.ELIGIBLE}, {i.CONTROL}, {i.BATCHES}
    SELECT coalesce(b.table_name, c.table_name) AS table_name,
           coalesce(b.new_watermark, c.last_watermark) AS last_updated_at,
           CASE WHEN b.table_name IS NULL THEN 'run_0' ELSE 'run_1' END AS updated_by_run,
           CASE WHEN b.table_name IS NULL THEN c.last_run_at WHEN c.table_name IS NOT NULL THEN {i.SQL_CHECKED_AT} END AS updated_at
    FROM control c FULL OUTER JOIN batches b ON c.table_name = b.table_name""",
)
def watermark_upsert(spark: SparkSession, sf: str) -> DataFrame:
    stored = i.control(spark, sf).select(
        "table_name",
        F.col("last_watermark").alias("last_updated_at"),
        F.lit("run_0").alias("updated_by_run"),
        F.col("last_run_at").alias("updated_at"),
    )
    results = i.batches(spark, sf).withColumnRenamed("new_watermark", "max_updated_at")
    return ctl.upsert_watermarks(stored, results, i.RUN_ID, i.CHECKED_AT)


@query(
    "pair_results",
    f"""WITH {i.ELIGIBLE}, {i.BATCHES} SELECT e.table_name, updated_at_col, pk_columns, row_count, new_watermark
    FROM eligible e JOIN batches b ON e.table_name = b.table_name""",
)
def pair_results(spark: SparkSession, sf: str) -> DataFrame:
    configs = i.eligible(spark, sf).select(
        "table_name", "updated_at_col", F.concat_ws(",", "pk_columns").alias("pk_columns")
    )
    return ctl.pair_results(configs, i.batches(spark, sf))


@query(
    "sync_tally",
    """SELECT count(*) AS synced_tables, string_agg(table_name, ',' ORDER BY table_name) AS table_names
    FROM (SELECT DISTINCT concat('t_', event_type) AS table_name FROM events WHERE value >= 1)""",
)
def sync_tally(spark: SparkSession, sf: str) -> DataFrame:
    """Tables, one per kind of event, with at least one row changed by a run."""
    runs = i.table(spark, sf, "events").filter("value >= 1")
    return ctl.sync_tally(runs.select(F.concat(F.lit("t_"), F.col("event_type")).alias("table_name")))
