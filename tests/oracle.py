"""Compare a query's Spark result with its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return repr(value)


def rows_of(table: pa.Table) -> list[tuple[str, ...]]:
    names = sorted(table.column_names)
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns)) if columns else []


def type_of(kind: pa.DataType) -> str:
    if pa.types.is_large_string(kind):
        return "string"
    if pa.types.is_timestamp(kind):
        return "timestamp" + ("_tz" if kind.tz else "")
    return str(kind)


def compare(spark_table: pa.Table, oracle_table: pa.Table) -> list[str]:
    """Differences in names, types, row count and values; none when equal."""
    have = {f.name: type_of(f.type) for f in spark_table.schema}
    want = {f.name: type_of(f.type) for f in oracle_table.schema}
    if set(have) != set(want):
        return [f"columns {sorted(have)} against {sorted(want)}"]
    found = [f"type of {n}: {have[n]} against {want[n]}" for n in sorted(have) if have[n] != want[n] and want[n] != "null"]
    if spark_table.num_rows != oracle_table.num_rows:
        return [*found, f"{spark_table.num_rows} rows against {oracle_table.num_rows}"]
    left, right = rows_of(spark_table), rows_of(oracle_table)
    if left != right:
        at = next(i for i, (a, b) in enumerate(zip(left, right)) if a != b)
        found.append(f"values differ, first at {at}: {left[at]} against {right[at]}")
    return found
