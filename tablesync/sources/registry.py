"""Source configuration and the registry of source kinds."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from tablesync.functions.typemap import ColumnMeta


@dataclass(frozen=True)
class SourceSpec:
    """One configured source. ``options`` are Spark reader options (url, user, path, ...).

    ``connections`` is how many a database may be asked for at once; it bounds the tasks of one read.
    """

    name: str
    kind: str
    schema: str
    target_schema: str
    options: dict[str, str] = field(default_factory=dict)
    include_views: bool | None = None
    connections: int = 64


class Source(Protocol):
    """What every source offers. Rows only ever travel as DataFrames."""

    kind: str
    schema: str

    def tables(self) -> list[str]: ...

    def columns(self, table: str) -> list[ColumnMeta]: ...

    def column_frame(self) -> DataFrame:
        """(table_schema, table_name, column_name, data_type, ordinal_position) of the whole schema."""

    def constraint_frame(self) -> DataFrame:
        """(table_schema, table_name, constraint_name, constraint_type)."""

    def key_usage_frame(self) -> DataFrame:
        """(table_schema, table_name, constraint_name, column_name, ordinal_position)."""

    def split_column(self, table: str) -> str | None:
        """Column to split a parallel read on, if the source needs one."""

    def read(self, table: str, split_by: str | None = None, rows: int | None = None) -> DataFrame: ...

    def count(self, table: str) -> int: ...


def open_source(spark: SparkSession, spec: SourceSpec) -> Source:
    from tablesync.sources.jdbc import MySqlSource, OracleSource, PostgresSource
    from tablesync.sources.lake import CatalogSource, ParquetSource

    kinds = {
        "postgres": PostgresSource,
        "mysql": MySqlSource,
        "oracle": OracleSource,
        "parquet": ParquetSource,
        "catalog": CatalogSource,
    }
    if spec.kind not in kinds:
        raise ValueError(f"unknown source kind {spec.kind!r}; known kinds: {sorted(kinds)}")
    return kinds[spec.kind](spark, spec)


def specs_from(entries: Iterable[dict]) -> list[SourceSpec]:
    return [
        SourceSpec(
            name=e["name"],
            kind=e["type"],
            schema=e["schema"],
            target_schema=e["target_schema"],
            options=dict(e.get("options", {})),
            include_views=e.get("include_views"),
            connections=int(e.get("connections", 64)),
        )
        for e in entries
    ]


def load_specs(path: str) -> list[SourceSpec]:
    """Read the ``sources`` list of a JSON or YAML file."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return specs_from(json.loads(text)["sources"])
    try:
        import yaml
    except ImportError as missing:
        raise ImportError("YAML source lists need PyYAML; use a .json file instead") from missing
    return specs_from(yaml.safe_load(text)["sources"])
