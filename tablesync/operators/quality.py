"""Gates: checks that must hold before data is published, and the profile of a batch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateFailed(ValueError):
    """A count or freshness check did not hold; nothing was published."""


def require_equal(label: str, expected: int, actual: int) -> None:
    if expected != actual:
        raise GateFailed(f"{label}: expected {expected} rows, found {actual}")


def count_gate(extracted: DataFrame, staged: DataFrame) -> DataFrame:
    """One row: extracted and staged counts and whether they agree, over two (row_count) frames."""
    both = extracted.select(F.col("row_count").alias("extracted_count"), F.lit(None).cast("bigint").alias("staged_count"))
    both = both.unionByName(
        staged.select(F.lit(None).cast("bigint").alias("extracted_count"), F.col("row_count").alias("staged_count"))
    )
    return both.agg(
        F.max("extracted_count").alias("extracted_count"), F.max("staged_count").alias("staged_count")
    ).withColumn("gate_ok", F.col("extracted_count") == F.col("staged_count"))


def freshness(df: DataFrame, column: str, as_of: date) -> DataFrame:
    """One row: rows dated ``as_of`` or later, and whether there is any."""
    recent = df.filter(F.col(column) >= F.lit(as_of))
    return recent.agg(F.count("*").alias("fresh_rows")).withColumn("is_fresh", F.col("fresh_rows") > 0)


def batch_profile(df: DataFrame, column: str) -> DataFrame:
    """One row: size of a batch and the range of its dates."""
    return df.agg(
        F.count("*").alias("row_count"), F.min(column).alias("min_value"), F.max(column).alias("max_value")
    )
