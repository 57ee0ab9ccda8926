"""Relational sources through Spark's JDBC reader.

A table is read in parallel: by ranges of a numeric, date or timestamp column, or, where the
key is text or not a whole number, by a hash of it that the database computes. Filters and column lists
reach the database through Spark's own push-down. Spark's reader pushes no aggregates, so counts,
minima and maxima are sent as statements. A sync reads a relation of changed rows only, split by their quantiles.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.naming import qualified, quote, text_literal
from tablesync.functions.typemap import ColumnMeta
from tablesync.operators.extract import INCLUSIVE
from tablesync.operators.metadata import pk_columns
from tablesync.sources.registry import SourceSpec

FETCH_ROWS = 50_000
ROWS_PER_TASK = 1_000_000


def task_count(rows: int, connections: int) -> int:
    """Tasks of a read: one a million rows, as far as the source serves so many connections at once."""
    return max(1, min(connections, -(-rows // ROWS_PER_TASK)))


class JdbcSource:
    """Catalog access and partitioned reads; subclasses give the dialect's catalog SQL."""

    kind = ""
    views_by_default = False

    def __init__(self, spark: SparkSession, spec: SourceSpec):
        self.spark = spark
        self.spec = spec
        self.schema = spec.schema
        self.include_views = self.views_by_default if spec.include_views is None else spec.include_views

    # -- dialect: catalog SQL and a hash predicate -------------------------------------------

    def tables_sql(self) -> str:
        raise NotImplementedError

    def columns_sql(self) -> str:
        raise NotImplementedError

    def constraints_sql(self) -> str:
        raise NotImplementedError

    def key_usage_sql(self) -> str:
        raise NotImplementedError

    def hash_predicate(self, column: str, tasks: int, number: int) -> str:
        raise NotImplementedError

    # -- reads -------------------------------------------------------------------------------

    def options(self) -> dict[str, str]:
        """Reader options shared by all reads; credentials and driver come from the spec."""
        return {
            "fetchsize": str(FETCH_ROWS),
            "preferTimestampNTZ": "true",
            **self.spec.options,
        }

    def relation(self, table: str) -> str:
        return qualified(self.kind, self.schema, table)

    def _load(self, relation: str, **extra: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options(), dbtable=relation, **extra).load()

    def _query(self, text: str) -> DataFrame:
        frame = self._load(f"({text}) q")
        return frame.toDF(*[c.lower() for c in frame.columns])

    def tables(self) -> list[str]:
        return [r[0] for r in self._query(self.tables_sql()).orderBy("table_name").collect()]

    # Each catalog view is asked once for the whole schema and kept as a local relation: a source is opened for one run, and a row a
    # column, constraint or key column is as much as the catalog holds.

    def _snapshot(self, sql: str) -> DataFrame:
        rows = self._query(sql)
        return self.spark.createDataFrame(rows.toArrow(), rows.schema)

    @cached_property
    def _column_snapshot(self) -> DataFrame:
        return self._snapshot(self.columns_sql())

    @cached_property
    def _constraint_snapshot(self) -> DataFrame:
        return self._snapshot(self.constraints_sql())

    @cached_property
    def _key_usage_snapshot(self) -> DataFrame:
        return self._snapshot(self.key_usage_sql())

    def column_frame(self) -> DataFrame:
        return self._column_snapshot

    def constraint_frame(self) -> DataFrame:
        return self._constraint_snapshot

    def key_usage_frame(self) -> DataFrame:
        return self._key_usage_snapshot

    @cached_property
    def _columns(self) -> dict[str, list[ColumnMeta]]:
        found: dict[str, list[ColumnMeta]] = {}
        for r in self.column_frame().orderBy("table_name", "ordinal_position").collect():
            found.setdefault(r["table_name"], []).append(ColumnMeta(r["column_name"], r["data_type"], r["num_precision"], r["num_scale"]))
        return found

    @cached_property
    def _leading_keys(self) -> dict[str, str]:
        keys = pk_columns(self.constraint_frame(), self.key_usage_frame(), self.schema)
        return {r["table_name"]: r["pk_columns"][0] for r in keys.collect()}

    def columns(self, table: str) -> list[ColumnMeta]:
        return self._columns.get(table, [])

    def split_column(self, table: str) -> str | None:
        """The leading key column: the database has an index on it."""
        return self._leading_keys.get(table)

    def count_sql(self, table: str) -> str:
        return f"SELECT COUNT(*) AS n FROM {self.relation(table)}"

    def bounds_sql(self, table: str, column: str) -> str:
        quoted = quote(self.kind, column)
        return f"SELECT MIN({quoted}) AS low, MAX({quoted}) AS high FROM {self.relation(table)}"

    def newest_sql(self, table: str, cursor: str, low: datetime) -> str:
        """The largest cursor above ``low``."""
        quoted = quote(self.kind, cursor)
        return f"SELECT MAX({quoted}) AS upper_watermark FROM {self.relation(table)} WHERE {quoted} > {self.timestamp_text(low)}"

    def changed_text(self, cursor: str, low: datetime, mode: str, high: datetime | None) -> str:
        """The condition of changed rows, as `is_changed` has it."""
        quoted = quote(self.kind, cursor)
        text = f"{quoted} {'>=' if mode == INCLUSIVE else '>'} {self.timestamp_text(low)}"
        return text if high is None else f"{text} AND {quoted} <= {self.timestamp_text(high)}"

    def changes_relation(self, table: str, changed: str) -> str:
        return f"(SELECT * FROM {self.relation(table)} WHERE {changed}) changes"

    def changed_count_sql(self, table: str, changed: str) -> str:
        return f"{self.count_sql(table)} WHERE {changed}"

    def null_cursors_sql(self, table: str, cursor: str) -> str:
        return f"{self.count_sql(table)} WHERE {quote(self.kind, cursor)} IS NULL"

    def quantiles_sql(self, table: str, column: str, changed: str, tasks: int) -> str:
        """The least value of each of ``tasks`` parts of equally many changed rows."""
        quoted = quote(self.kind, column)
        ranked = f"SELECT {quoted} AS k, NTILE({tasks}) OVER (ORDER BY {quoted}) AS part FROM {self.relation(table)} WHERE ({changed}) AND {quoted} IS NOT NULL"
        return f"SELECT MIN(k) AS low FROM ({ranked}) ranked GROUP BY part"

    def literal(self, value: object) -> str:
        if isinstance(value, datetime):
            return self.timestamp_text(value)
        if isinstance(value, date):
            return f"DATE {text_literal(value.isoformat())}"
        return text_literal(value) if isinstance(value, str) else str(value)

    def quantile_predicates(self, column: str, lows: list) -> list[str]:
        """Disjoint ranges that together cover all values; NULLs go with the first. A value that fills several parts is one range."""
        quoted = quote(self.kind, column)
        edges = [self.literal(v) for v in sorted(set(lows))[1:]]
        if not edges:
            return ["1 = 1"]
        inner = [f"{quoted} >= {a} AND {quoted} < {b}" for a, b in zip(edges, edges[1:])]
        return [f"{quoted} < {edges[0]} OR {quoted} IS NULL", *inner, f"{quoted} >= {edges[-1]}"]

    def read_changes(self, table: str, cursor: str, low: datetime, mode: str, high: datetime | None, split_by: str) -> DataFrame:
        """Changed rows only. Their number is counted, and the read is split by their quantiles, whatever gaps and outliers the
        table has; nothing is asked about other rows. Text keys are split by hash, as databases order text in ways of their own."""
        changed = self.changed_text(cursor, low, mode, high)
        relation = self.changes_relation(table, changed)
        tasks = task_count(int(self._query(self.changed_count_sql(table, changed)).first()["n"]), self.spec.connections)
        rows = self._load(relation)
        if tasks == 1:
            return rows
        kind = rows.schema[split_by].dataType
        if splits_by_range(kind) or isinstance(kind, T.DecimalType):
            lows = [r["low"] for r in self._query(self.quantiles_sql(table, split_by, changed, tasks)).collect()]
            predicates = self.quantile_predicates(split_by, lows)
        else:
            predicates = self.split_predicates(split_by, tasks)
        properties = {k: v for k, v in self.options().items() if k != "url"}
        return self.spark.read.jdbc(url=self.spec.options["url"], table=relation, predicates=predicates, properties=properties)

    def null_cursors(self, table: str, cursor: str) -> int:
        return int(self._query(self.null_cursors_sql(table, cursor)).first()["n"])

    def timestamp_text(self, at: datetime) -> str:
        return f"TIMESTAMP {text_literal(at.strftime('%Y-%m-%d %H:%M:%S.%f'))}"

    def count(self, table: str) -> int:
        return int(self._query(self.count_sql(table)).first()["n"])

    def newest(self, table: str, cursor: str, low: datetime) -> datetime | None:
        return self._query(self.newest_sql(table, cursor, low)).select(F.col("upper_watermark").cast("timestamp_ntz")).first()[0]

    def read(self, table: str, split_by: str | None = None, rows: int | None = None) -> DataFrame:
        """Whole table, in one task unless ``split_by`` names a column to split on."""
        relation = self.relation(table)
        if split_by is None:
            return self._load(relation)
        whole = self._load(relation)
        tasks = task_count(self.count(table) if rows is None else rows, self.spec.connections)
        if tasks == 1:
            return whole
        if splits_by_range(whole.schema[split_by].dataType):
            found = self._query(self.bounds_sql(table, split_by)).first()
            return self._load(relation, **range_options(quote(self.kind, split_by), found["low"], found["high"], tasks))
        return self.spark.read.jdbc(
            url=self.spec.options["url"],
            table=relation,
            predicates=self.split_predicates(split_by, tasks),
            properties={k: v for k, v in self.options().items() if k != "url"},
        )

    def split_predicates(self, column: str, tasks: int) -> list[str]:
        """Disjoint predicates that together cover the table; NULLs go with the first."""
        quoted = quote(self.kind, column)
        parts = [self.hash_predicate(quoted, tasks, i) for i in range(tasks)]
        return [f"{parts[0]} OR {quoted} IS NULL", *parts[1:]]


def splits_by_range(kind: T.DataType) -> bool:
    """Whole numbers and times have evenly spaced bounds that Spark's reader takes; all else is split by hash."""
    if isinstance(kind, T.DecimalType):
        return kind.scale == 0 and kind.precision <= 18
    return isinstance(kind, (T.IntegralType, T.DateType, T.TimestampNTZType, T.TimestampType))


def _bound(value: object) -> str:
    return str(int(value)) if isinstance(value, (Decimal, float)) else str(value)


def range_options(column: str, low: object, high: object, tasks: int) -> dict[str, str]:
    return {
        "partitionColumn": column,
        "lowerBound": _bound(low),
        "upperBound": _bound(high),
        "numPartitions": str(tasks),
    }


def _information_schema_columns(schema: str) -> str:
    return (
        "SELECT table_schema, table_name, column_name, data_type, ordinal_position, "
        "numeric_precision AS num_precision, numeric_scale AS num_scale "
        f"FROM information_schema.columns WHERE table_schema = {text_literal(schema)}"
    )


def _information_schema_constraints(schema: str) -> str:
    return (
        "SELECT table_schema, table_name, constraint_name, constraint_type "
        f"FROM information_schema.table_constraints WHERE table_schema = {text_literal(schema)}"
    )


class PostgresSource(JdbcSource):
    kind = "postgres"

    def tables_sql(self) -> str:
        where = f"WHERE schemaname = {text_literal(self.schema)}"
        listing = f"SELECT tablename AS table_name FROM pg_tables {where}"
        if self.include_views:
            listing += f" UNION ALL SELECT viewname FROM pg_views {where}"
        return listing

    def columns_sql(self) -> str:
        return _information_schema_columns(self.schema)

    def constraints_sql(self) -> str:
        return _information_schema_constraints(self.schema)

    def key_usage_sql(self) -> str:
        return (
            "SELECT table_schema, table_name, constraint_name, column_name, ordinal_position "
            f"FROM information_schema.key_column_usage WHERE table_schema = {text_literal(self.schema)}"
        )

    def hash_predicate(self, column: str, tasks: int, number: int) -> str:
        return f"(hashtext({column}::text) & 2147483647) % {tasks} = {number}"


class MySqlSource(JdbcSource):
    kind = "mysql"
    views_by_default = True  # its table listing has no table-type predicate

    def tables_sql(self) -> str:
        text = f"SELECT table_name FROM information_schema.tables WHERE table_schema = {text_literal(self.schema)}"
        return text if self.include_views else text + " AND table_type = 'BASE TABLE'"

    def columns_sql(self) -> str:
        return _information_schema_columns(self.schema)

    def constraints_sql(self) -> str:
        return _information_schema_constraints(self.schema)

    def key_usage_sql(self) -> str:
        # every MySQL key is called PRIMARY, so the table name is part of the constraint's identity
        return (
            "SELECT table_schema, table_name, constraint_name, column_name, ordinal_position "
            f"FROM information_schema.key_column_usage WHERE table_schema = {text_literal(self.schema)}"
        )

    def hash_predicate(self, column: str, tasks: int, number: int) -> str:
        return f"CRC32({column}) % {tasks} = {number}"


class OracleSource(JdbcSource):
    kind = "oracle"

    def __init__(self, spark: SparkSession, spec: SourceSpec):
        super().__init__(spark, spec)
        self.schema = spec.schema.upper()

    def tables_sql(self) -> str:
        owner = f"WHERE owner = {text_literal(self.schema)}"
        listing = f"SELECT table_name FROM all_tables {owner}"
        if self.include_views:
            listing += f" UNION ALL SELECT view_name FROM all_views {owner}"
        return listing

    def columns_sql(self) -> str:
        return (
            "SELECT owner AS table_schema, table_name, column_name, data_type, column_id AS ordinal_position, "
            "data_precision AS num_precision, data_scale AS num_scale "
            f"FROM all_tab_columns WHERE owner = {text_literal(self.schema)}"
        )

    def constraints_sql(self) -> str:
        return (
            "SELECT owner AS table_schema, table_name, constraint_name, "
            "CASE constraint_type WHEN 'P' THEN 'PRIMARY KEY' ELSE constraint_type END AS constraint_type "
            f"FROM all_constraints WHERE owner = {text_literal(self.schema)}"
        )

    def key_usage_sql(self) -> str:
        return (
            "SELECT owner AS table_schema, table_name, constraint_name, column_name, position AS ordinal_position "
            f"FROM all_cons_columns WHERE owner = {text_literal(self.schema)}"
        )

    def columns(self, table: str) -> list[ColumnMeta]:
        return super().columns(table.upper())

    def hash_predicate(self, column: str, tasks: int, number: int) -> str:
        return f"ORA_HASH({column}, {tasks - 1}) = {number}"
