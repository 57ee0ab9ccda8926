"""The Spark session of tests and benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", memory: str = "8g", **conf: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="tablesync-session-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablesync")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.catalogImplementation", "in-memory")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
