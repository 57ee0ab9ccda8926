"""Registry, catalog SQL and read splitting. No database is started: JDBC sources are tested as text."""

from __future__ import annotations

import json

import pytest

from tablesync.sources import SourceSpec, load_specs, open_source
from tablesync.sources.jdbc import range_options, splits_by_range, task_count


def spec(kind, schema="public", **more):
    return SourceSpec("s", kind, schema, "target", {"url": "jdbc:none", "user": "u"}, **more)


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="known kinds"):
        open_source(spark, spec("db2"))


@pytest.mark.parametrize("ending", ["json", "yaml"])
def test_load_specs(tmp_path, ending):
    path = tmp_path / f"sources.{ending}"
    entry = {"name": "a", "type": "mysql", "schema": "my_db", "target_schema": "T", "options": {"url": "jdbc:x"}}
    path.write_text(json.dumps({"sources": [entry]}))  # JSON is YAML too
    assert load_specs(str(path)) == [SourceSpec("a", "mysql", "my_db", "T", {"url": "jdbc:x"})]


def test_catalog_sql(spark):
    pg, my, ora = (open_source(spark, spec(k, "Erp'x")) for k in ("postgres", "mysql", "oracle"))
    assert pg.tables_sql() == "SELECT tablename AS table_name FROM pg_tables WHERE schemaname = 'Erp''x'"
    assert my.tables_sql().endswith("WHERE table_schema = 'Erp''x'")  # no table-type predicate: views too
    assert "owner = 'ERP''X'" in ora.tables_sql()
    for source in (pg, my, ora):
        assert "ordinal_position" in source.columns_sql() and "constraint_name" in source.constraints_sql()
        assert "table_name" in source.key_usage_sql()


def test_views_can_be_asked_for_or_left_out(spark):
    assert "pg_views" in open_source(spark, spec("postgres", include_views=True)).tables_sql()
    assert "BASE TABLE" in open_source(spark, spec("mysql", include_views=False)).tables_sql()
    assert "all_views" in open_source(spark, spec("oracle", include_views=True)).tables_sql()


def test_relations_are_quoted(spark):
    assert open_source(spark, spec("postgres")).relation('we"ird') == '"public"."we""ird"'
    assert open_source(spark, spec("mysql", "db")).relation("a`b") == "`db`.`a``b`"
    assert open_source(spark, spec("oracle", "erp")).relation("T") == '"ERP"."T"'


def test_split_predicates_cover_the_table(spark):
    parts = open_source(spark, spec("postgres")).split_predicates("uuid", 3)
    assert len(parts) == 3 and parts[0].endswith('OR "uuid" IS NULL')
    assert [p for p in parts[1:] if "IS NULL" in p] == []
    assert open_source(spark, spec("oracle")).split_predicates("k", 4)[1] == 'ORA_HASH("k", 3) = 1'
    assert open_source(spark, spec("mysql")).split_predicates("k", 4)[2] == "CRC32(`k`) % 4 = 2"


def test_options(spark):
    options = open_source(spark, spec("mysql")).options()
    assert options["fetchsize"] == "50000" and options["preferTimestampNTZ"] == "true" and options["user"] == "u"
    assert range_options('"id"', 1, 9, 4) == {
        "partitionColumn": '"id"', "lowerBound": "1", "upperBound": "9", "numPartitions": "4",
    }


def test_task_count():
    assert [task_count(n, 64) for n in (0, 1, 1_000_001, 10**12)] == [1, 1, 2, 64]
    assert task_count(10**12, 5000) == 5000


def test_catalog_source(spark, schema_name):
    spark.sql(f"CREATE DATABASE {schema_name}")
    spark.range(4).write.saveAsTable(f"{schema_name}.t")
    spark.sql(f"CREATE VIEW {schema_name}.v AS SELECT 1 AS x")
    lake = open_source(spark, SourceSpec("l", "catalog", schema_name, "x"))
    assert lake.tables() == ["t"] and lake.count("t") == 4
    assert [(c.name, c.native_type) for c in lake.columns("t")] == [("id", "bigint")]
    assert lake.column_frame().count() == 1
    both = open_source(spark, SourceSpec("l", "catalog", schema_name, "x", include_views=True))
    assert both.tables() == ["t", "v"]
