"""Daily forecast: columnar JSON documents to rows, upserted by date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablesync.functions.coerce import ntz
from tablesync.operators.quality import GateFailed, freshness
from tablesync.plans.full_load import RETENTION
from tablesync.plans.livetable import LiveTable
from tablesync.plans.staging import gate, run_directory, stage
from tablesync.plans.sync import merge_batch
from tablesync.sources.landing import FORECAST_MEASURES, columnar_rows, read_landing


def forecast_schema(measures: Sequence[str] = FORECAST_MEASURES) -> T.StructType:
    fields = [T.StructField("forecast_date", T.DateType())]
    fields += [T.StructField(m, T.DoubleType()) for m in measures]
    return T.StructType([*fields, T.StructField("loaded_at", T.TimestampNTZType())])


def load_forecast(
    spark: SparkSession,
    landing: str | DataFrame,
    live: LiveTable,
    staging_root: str,
    run_id: str,
    as_of: datetime,
    measures: Sequence[str] = FORECAST_MEASURES,
    retention: float = RETENTION,
) -> int:
    """Upsert the landed documents by date and stamp the load time; returns the staged row count.

    Raises, before anything is published, if after the load no row would be dated ``as_of`` or later.
    """
    schema = forecast_schema(measures)
    documents = read_landing(spark, landing, measures) if isinstance(landing, str) else landing
    rows = columnar_rows(documents, measures).withColumn("loaded_at", ntz(as_of))
    live.ensure(schema)
    with run_directory(spark, staging_root, run_id, live.name) as staging:
        batch = stage(rows, schema, staging, keys=("forecast_date",), slices=live.slices)
        gate(spark, batch, live.name)
        dates = batch.read(spark).select("forecast_date").unionByName(live.read().select("forecast_date"))
        if not freshness(dates, "forecast_date", as_of.date()).first()["is_fresh"]:
            raise GateFailed(f"{live.name}: no row dated {as_of.date()} or later")
        merge_batch(spark, live, batch, ("forecast_date",), None, run_id)
    live.expire(retention)
    return batch.rows
