"""Status rules of reconciliation records and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablesync.functions.coerce import numeric_or_zero

# Labels shown by the report, in order of severity.
LABEL_FAILED = "🔴 FAILED"
LABEL_MISMATCH = "🟠 MISMATCH"
LABEL_OK = "🟢 정상"


def status_is(status: Column, wanted: str) -> Column:
    """Case-insensitive equality that is false, not NULL, for a missing status."""
    return F.coalesce(F.upper(status) == F.lit(wanted.upper()), F.lit(False))


def display_status(status: Column, diff: Column) -> Column:
    """A failed run wins over a count difference; a difference that is no number counts as none."""
    return (
        F.when(status_is(status, "FAILED"), F.lit(LABEL_FAILED))
        .when(numeric_or_zero(diff) != 0, F.lit(LABEL_MISMATCH))
        .otherwise(F.lit(LABEL_OK))
    )


def count_status(diff: Column, unequal: str) -> Column:
    return F.when(diff == 0, F.lit("SUCCESS")).otherwise(F.lit(unequal))
