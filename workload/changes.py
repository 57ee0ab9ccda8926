"""Extraction, merge, interval and gate queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.coerce import ntz
from tablesync.functions.flags import active_condition, delete_condition
from tablesync.operators import extract as ex
from tablesync.operators import merge as mg
from tablesync.operators import reconcile as rc
from tablesync.operators.interval import interval_count, replace_interval
from tablesync.operators.metadata import evolve
from tablesync.operators.quality import count_gate
from tablesync.plans.files import run_folder
from tablesync.plans.frames import small_frame
from tablesync.plans.staging import run_directory, stage
from workload import inputs as i
from workload.registry import query

CURSOR = "o_orderdate"
ORDER = mg.MergeSpec(("o_orderkey",))
FLAGGED = mg.MergeSpec(("o_orderkey",), "is_deleted")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return i.table(spark, sf, "orders")


# -- extraction --------------------------------------------------------------------------------


@query("cdc_extract_strict", f"SELECT * FROM orders WHERE o_orderdate > {i.SQL_LO}")
def cdc_extract_strict(spark: SparkSession, sf: str) -> DataFrame:
    return ex.extract_changes(_orders(spark, sf), CURSOR, i.LO, ex.STRICT)


@query(
    "cdc_extract_inclusive",
    f"""SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS updated_at FROM orders)
    WHERE updated_at >= {i.SQL_LO} AND updated_at IS NOT NULL""",
)
def cdc_extract_inclusive(spark: SparkSession, sf: str) -> DataFrame:
    """Pending orders have no cursor."""
    cursor = F.when(F.col("o_orderstatus") != "P", F.col(CURSOR))
    return ex.extract_changes(
        _orders(spark, sf).select("o_orderkey", cursor.alias("updated_at")), "updated_at", i.LO, ex.INCLUSIVE
    )


@query("cdc_extract_bounded", f"SELECT * FROM orders WHERE o_orderdate > {i.SQL_LO} AND o_orderdate <= {i.SQL_HI}")
def cdc_extract_bounded(spark: SparkSession, sf: str) -> DataFrame:
    return ex.extract_changes(_orders(spark, sf), CURSOR, i.LO, ex.BOUNDED, i.HI)


@query(
    "cdc_overlap",
    f"""SELECT o_orderkey, o_totalprice, o_orderdate, o_orderdate <= {i.SQL_LO} AS read_again FROM orders
    WHERE o_orderdate > {i.SQL_LO} - INTERVAL 30 DAY AND o_orderdate <= {i.SQL_HI}""",
)
def cdc_overlap(spark: SparkSession, sf: str) -> DataFrame:
    rows = _orders(spark, sf).select("o_orderkey", "o_totalprice", CURSOR)
    late = ex.extract_changes(rows, CURSOR, i.LO, ex.BOUNDED, i.HI, overlap=timedelta(days=30))
    return late.withColumn("read_again", F.col(CURSOR) <= ntz(i.LO))


@query("upper_watermark", f"SELECT max(o_orderdate) AS upper_watermark FROM orders WHERE o_orderdate > {i.SQL_LO}")
def upper_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return ex.upper_watermark(_orders(spark, sf), CURSOR, i.LO)


@query(
    "next_watermark",
    f"""SELECT 'bounded' AS batch, max(o_orderdate) AS next_watermark FROM orders
      WHERE o_orderdate > {i.SQL_LO} AND o_orderdate <= {i.SQL_HI}
    UNION ALL SELECT 'inclusive', max(o_orderdate) + INTERVAL 1 MICROSECOND FROM orders WHERE o_orderdate >= {i.SQL_LO}
    UNION ALL SELECT 'empty', coalesce(max(o_orderdate), TIMESTAMP '2030-01-01 00:00:00') FROM orders
      WHERE o_orderdate > TIMESTAMP '2030-01-01 00:00:00'""",
)
def next_watermark(spark: SparkSession, sf: str) -> DataFrame:
    orders, future = _orders(spark, sf), datetime(2030, 1, 1)
    cases = [
        ("bounded", ex.extract_changes(orders, CURSOR, i.LO, ex.BOUNDED, i.HI), i.LO, ex.BOUNDED),
        ("inclusive", ex.extract_changes(orders, CURSOR, i.LO, ex.INCLUSIVE), i.LO, ex.INCLUSIVE),
        ("empty", ex.extract_changes(orders, CURSOR, future, ex.STRICT), future, ex.STRICT),
    ]
    rows = [
        ex.next_watermark(batch, CURSOR, old, mode).select(F.lit(name).alias("batch"), "next_watermark")
        for name, batch, old, mode in cases
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("changed_tables", f"WITH {i.BATCHES} SELECT table_name, row_count FROM batches WHERE row_count > 0")
def changed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer's table with its number of changed rows; those without any drop out."""
    changed = (F.col(CURSOR) > ntz(i.LO)) & (F.col(CURSOR) <= ntz(i.HI))
    table_name = F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("table_name")
    counts = _orders(spark, sf).groupBy(table_name).agg(F.count_if(changed).alias("row_count"))
    return ex.changed_only(counts)


@query("ordered_extract", f"SELECT * FROM orders WHERE o_orderdate > {i.SQL_LO} ORDER BY o_orderdate")
def ordered_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted as staged: inside each file."""
    return ex.order_for_files(ex.extract_changes(_orders(spark, sf), CURSOR, i.LO, ex.STRICT), CURSOR)


@query("ordered_extract_pk", f"SELECT * FROM orders WHERE o_orderdate >= {i.SQL_LO} ORDER BY o_orderdate, o_orderkey")
def ordered_extract_pk(spark: SparkSession, sf: str) -> DataFrame:
    return ex.order_total(ex.extract_changes(_orders(spark, sf), CURSOR, i.LO, ex.INCLUSIVE), CURSOR, ["o_orderkey"])


# -- merge -------------------------------------------------------------------------------------

_UNMATCHED_KEPT = "NOT EXISTS (SELECT 1 FROM m_stg s WHERE s.o_orderkey = t.o_orderkey)"


@query(
    "merge_upsert",
    f"""WITH t AS (SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate <= {i.SQL_HI}),
    s AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderdate > {i.SQL_LO})
    SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
    UNION ALL SELECT s.o_orderkey, s.o_totalprice, t.o_orderpriority FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey""",
)
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The target has a column the source does not know; updates keep it, inserts leave it NULL."""
    target = _orders(spark, sf).filter(F.col(CURSOR) <= ntz(i.HI)).select("o_orderkey", "o_totalprice", "o_orderpriority")
    return mg.merge(target, i.merge_batch(spark, sf).drop("is_deleted"), ORDER)


@query(
    "merge_soft_delete",
    f"""WITH {i.M_TGT}, {i.M_STG} SELECT t.* FROM m_tgt t WHERE {_UNMATCHED_KEPT}
    UNION ALL SELECT * FROM m_stg WHERE is_deleted IS NULL OR is_deleted = false""",
)
def merge_soft_delete(spark: SparkSession, sf: str) -> DataFrame:
    return mg.merge(i.merge_target(spark, sf), i.merge_batch(spark, sf), FLAGGED)


@query(
    "merge_composite",
    """WITH t AS (SELECT * FROM conversations WHERE turn <= 2),
    s AS (SELECT conv_id, turn, concat(role, '_edited') AS role, text FROM conversations WHERE turn >= 2)
    SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.conv_id = t.conv_id AND s.turn = t.turn)
    UNION ALL SELECT * FROM s""",
)
def merge_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Later turns arrive; the last known one was edited. The key is conversation and turn."""
    rows = i.table(spark, sf, "conversations")
    staged = rows.filter("turn >= 2").withColumn("role", F.concat("role", F.lit("_edited")))
    return mg.merge(rows.filter("turn <= 2"), staged, mg.MergeSpec(("conv_id", "turn")))


@query(
    "schema_evolution",
    f"""WITH {i.M_TGT}, s AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, o_orderpriority FROM orders WHERE o_orderdate > {i.SQL_LO})
    SELECT t.o_orderkey, t.o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM m_tgt t
    WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM s""",
)
def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """The source gained a column: the target gains it too, NULL in rows the batch does not touch."""
    staged = i.merge_batch(spark, sf, "o_orderpriority").drop("is_deleted")
    return mg.merge(evolve(i.merge_target(spark, sf).drop("is_deleted"), staged), staged, ORDER)


_JOINED = f"WITH {i.M_TGT}, {i.M_STG} SELECT s.* FROM m_stg s"


@query(
    "cdc_inserts",
    f"{_JOINED} LEFT JOIN m_tgt t ON s.o_orderkey = t.o_orderkey WHERE t.o_orderkey IS NULL AND NOT (s.is_deleted = TRUE)",
)
def cdc_inserts(spark: SparkSession, sf: str) -> DataFrame:
    return mg.rows_to_insert(i.merge_target(spark, sf), i.merge_batch(spark, sf), FLAGGED)


@query("cdc_updates", f"{_JOINED} JOIN m_tgt t ON s.o_orderkey = t.o_orderkey WHERE NOT (s.is_deleted = TRUE)")
def cdc_updates(spark: SparkSession, sf: str) -> DataFrame:
    return mg.rows_to_update(i.merge_target(spark, sf), i.merge_batch(spark, sf), FLAGGED)


@query("cdc_deletes", f"{_JOINED} JOIN m_tgt t ON s.o_orderkey = t.o_orderkey WHERE s.is_deleted = TRUE")
def cdc_deletes(spark: SparkSession, sf: str) -> DataFrame:
    return mg.rows_to_delete(i.merge_target(spark, sf), i.merge_batch(spark, sf), FLAGGED)


_COUNTED = f"WITH {i.M_TGT}, {i.M_STG}"
_PAIR = "FROM m_stg s {} JOIN m_tgt t ON s.o_orderkey = t.o_orderkey"


@query(
    "cdc_change_counts",
    f"""{_COUNTED} SELECT
    (SELECT count(*) {_PAIR.format('LEFT')} WHERE t.o_orderkey IS NULL AND NOT (s.is_deleted = TRUE)) AS inserted_row_count,
    (SELECT count(*) {_PAIR.format('')} WHERE NOT (s.is_deleted = TRUE)) AS updated_row_count,
    (SELECT count(*) {_PAIR.format('')} WHERE s.is_deleted = TRUE) AS deleted_row_count""",
)
def cdc_change_counts(spark: SparkSession, sf: str) -> DataFrame:
    return mg.change_counts(i.merge_target(spark, sf), i.merge_batch(spark, sf), FLAGGED)


@query(
    "merge_effect_counts",
    f"""{_COUNTED}, j AS (SELECT t.o_orderkey IS NOT NULL AS m, coalesce(s.is_deleted, false) AS d {_PAIR.format('LEFT')})
    SELECT count(*) FILTER (WHERE NOT m AND NOT d) AS inserted_rows, count(*) FILTER (WHERE m AND NOT d) AS updated_rows,
           count(*) FILTER (WHERE m AND d) AS deleted_rows, count(*) FILTER (WHERE NOT m AND d) AS ignored_rows FROM j""",
)
def merge_effect_counts(spark: SparkSession, sf: str) -> DataFrame:
    return mg.effect_counts(i.merge_target(spark, sf), i.merge_batch(spark, sf), FLAGGED)


@query(
    "delete_flag_split",
    f"WITH {i.M_STG} SELECT o_orderkey, is_deleted = TRUE AS is_delete, NOT (is_deleted = TRUE) AS is_active FROM m_stg",
)
def delete_flag_split(spark: SparkSession, sf: str) -> DataFrame:
    staged = i.merge_batch(spark, sf)
    return staged.select(
        "o_orderkey",
        delete_condition(staged, "is_deleted").alias("is_delete"),
        active_condition(staged, "is_deleted").alias("is_active"),
    )


# -- the whole sync as one lazy plan -----------------------------------------------------------

_SYNCED = f"""WITH t AS (SELECT * REPLACE (o_totalprice - 1 AS o_totalprice) FROM orders WHERE o_orderdate <= {i.SQL_HI}),
    s AS (SELECT * FROM orders WHERE o_orderdate > {i.SQL_LO}
      AND o_orderdate <= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate > {i.SQL_LO}))
    SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
    UNION ALL SELECT * FROM s"""


def _stale_and_changed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    source = _orders(spark, sf)
    stale = source.filter(F.col(CURSOR) <= ntz(i.HI)).withColumn("o_totalprice", F.col("o_totalprice") - 1)
    high = ex.upper_watermark(source, CURSOR, i.LO).scalar()
    return stale, ex.extract_changes(source, CURSOR, i.LO, ex.BOUNDED, high)


@query("cdc_sync", _SYNCED)
def cdc_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Target as of HI with stale prices; everything after LO is extracted up to the upper bound and merged."""
    stale, changed = _stale_and_changed(spark, sf)
    return mg.merge(stale, changed, ORDER)


@query("cdc_replay_idempotent", _SYNCED)
def cdc_replay_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """The batch is merged, the cursor is lost, the batch is merged again."""
    stale, changed = _stale_and_changed(spark, sf)
    return mg.merge(mg.merge(stale, changed, ORDER), changed, ORDER)


# -- intervals ---------------------------------------------------------------------------------

def _events(spark: SparkSession, sf: str) -> DataFrame:
    return i.table(spark, sf, "events")


def _replaced(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = _events(spark, sf)
    batch = ex.extract_interval(events, "ts", i.START, i.END)
    stale = events.withColumn("value", F.col("value") + 1)
    return batch, replace_interval(stale, batch, "ts", i.START, i.END)


_IN = f"ts >= {i.SQL_START} AND ts < {i.SQL_END}"


@query("interval_extract", f"SELECT * FROM events WHERE {_IN}")
def interval_extract(spark: SparkSession, sf: str) -> DataFrame:
    return ex.extract_interval(_events(spark, sf), "ts", i.START, i.END)


@query(
    "interval_replace",
    f"SELECT * REPLACE (CASE WHEN {_IN} THEN value ELSE value + 1 END AS value) FROM events",
)
def interval_replace(spark: SparkSession, sf: str) -> DataFrame:
    return _replaced(spark, sf)[1]


@query(
    "interval_gate",
    f"SELECT count(*) AS extracted_count, count(*) AS staged_count, true AS gate_ok FROM events WHERE {_IN}",
)
def interval_gate(spark: SparkSession, sf: str) -> DataFrame:
    batch, replaced = _replaced(spark, sf)
    return count_gate(
        batch.agg(F.count("*").alias("row_count")),
        interval_count(replaced, "ts", i.START, i.END).withColumnRenamed("interval_rows", "row_count"),
    )


@query(
    "resolve_interval",
    """WITH r AS (SELECT o_orderkey AS run_no, o_orderdate AS logical_date, o_orderdate - INTERVAL 1 DAY AS start_at,
      CASE WHEN o_orderstatus = 'P' THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END AS end_at FROM orders)
    SELECT *, CASE WHEN start_at < end_at THEN start_at ELSE logical_date - INTERVAL 1 DAY END AS interval_start,
      CASE WHEN start_at < end_at THEN end_at ELSE logical_date END AS interval_end FROM r""",
)
def resolve_interval(spark: SparkSession, sf: str) -> DataFrame:
    """One run per order; runs of pending orders come with an empty interval."""
    day_before = F.col(CURSOR) - F.expr("INTERVAL 1 DAY")
    runs = _orders(spark, sf).select(
        F.col("o_orderkey").alias("run_no"),
        F.col(CURSOR).alias("logical_date"),
        day_before.alias("start_at"),
        F.when(F.col("o_orderstatus") == "P", day_before).otherwise(F.col(CURSOR)).alias("end_at"),
    )
    return ex.resolve_interval(runs, "start_at", "end_at", "logical_date")


# -- gates and records -------------------------------------------------------------------------


@query(
    "staged_gate",
    f"SELECT count(*) AS extracted_count, count(*) AS staged_count, true AS gate_ok FROM orders WHERE o_orderdate > {i.SQL_LO}",
)
def staged_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Really staged: the first count is observed by the pass that writes, the second read back."""
    changed = ex.extract_changes(_orders(spark, sf), CURSOR, i.LO, ex.STRICT)
    with run_directory(spark, run_folder(spark, "gate"), i.RUN_ID, "orders") as path:
        batch = stage(changed, changed.schema, path, CURSOR, ["o_orderkey"])
        staged = batch.read(spark).count()
    counts = small_frame(spark, [(batch.rows, staged)], T.StructType.fromDDL("extracted bigint, staged bigint"))
    return count_gate(
        counts.select(F.col("extracted").alias("row_count")), counts.select(F.col("staged").alias("row_count"))
    )


@query(
    "reconcile_counts",
    f"""WITH {i.COUNTS} SELECT table_name, source_count, target_count, source_count - target_count AS count_diff,
    CASE WHEN source_count = target_count THEN 'SUCCESS' ELSE 'MISMATCH' END AS status FROM rec""",
)
def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rc.reconcile_counts(i.source_counts(spark, sf), i.target_counts(spark, sf), "MISMATCH")


@query(
    "full_load_record",
    f"""WITH {i.COUNTS} SELECT 'run_1' AS run_id, 'FULL_LOAD' AS pipeline_type, r.table_name,
    {i.SQL_AS_OF} AS start_time, {i.SQL_CHECKED_AT} AS end_time,
    CASE WHEN source_count = target_count THEN 'SUCCESS' ELSE 'FAILED' END AS status,
    source_count AS pg_count, target_count AS sf_count, source_count - target_count AS count_diff,
    s.row_count AS extracted_count, s.row_count AS staged_count, CAST(NULL AS TIMESTAMP) AS watermark,
    CASE WHEN source_count <> target_count THEN concat(r.table_name, ' mismatch: source=', CAST(source_count AS VARCHAR),
      ', target=', CAST(target_count AS VARCHAR)) END AS error_message
    FROM rec r LEFT JOIN src s ON r.table_name = s.table_name""",
)
def full_load_record(spark: SparkSession, sf: str) -> DataFrame:
    source = i.source_counts(spark, sf)
    compared = rc.reconcile_counts(source, i.target_counts(spark, sf), "FAILED")
    staged = source.select(
        "table_name", F.col("row_count").alias("extracted_count"), F.col("row_count").alias("staged_count")
    )
    return rc.full_load_records(compared, i.RUN_ID, i.AS_OF, i.CHECKED_AT, staged)


@query(
    "cdc_record",
    f"""WITH {i.COUNTS}, {i.ELIGIBLE}, {i.CONTROL}, chg AS (
      SELECT concat('t', CAST(o_custkey AS VARCHAR)) AS table_name, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'O') AS ins,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS upd, count(*) FILTER (WHERE o_orderstatus = 'P') AS del
      FROM orders WHERE o_orderdate > {i.SQL_LO} AND o_orderdate <= {i.SQL_HI} GROUP BY 1)
    SELECT 'run_1' AS dag_run_id, r.table_name, {i.SQL_CHECKED_AT} AS checked_at,
      CASE WHEN source_count = target_count THEN 'SUCCESS' ELSE 'MISMATCH' END AS status,
      source_count AS source_row_count, target_count AS target_row_count, source_count - target_count AS row_count_diff,
      coalesce(n, 0) AS cdc_row_count, coalesce(ins, 0) AS inserted_row_count, coalesce(upd, 0) AS updated_row_count,
      coalesce(del, 0) AS deleted_row_count, c.last_watermark, c.last_run_at AS last_cdc_run_at
    FROM rec r LEFT JOIN chg g ON r.table_name = g.table_name LEFT JOIN control c ON r.table_name = c.table_name""",
)
def cdc_record(spark: SparkSession, sf: str) -> DataFrame:
    compared = rc.reconcile_counts(i.source_counts(spark, sf), i.target_counts(spark, sf), "MISMATCH")
    changed = ex.extract_changes(_orders(spark, sf), CURSOR, i.LO, ex.BOUNDED, i.HI)
    changes = changed.groupBy(F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("table_name")).agg(
        F.count("*").alias("cdc_row_count"),
        F.count_if(F.col("o_orderstatus") == "O").alias("inserted_row_count"),
        F.count_if(F.col("o_orderstatus") == "F").alias("updated_row_count"),
        F.count_if(F.col("o_orderstatus") == "P").alias("deleted_row_count"),
    )
    return rc.cdc_records(compared, changes, i.control(spark, sf), i.RUN_ID, i.CHECKED_AT)
