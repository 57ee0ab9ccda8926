"""Merge truth table, properties, and a comparison with a row-by-row model."""

from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs

from tablesync.operators import merge as mg

KEY = mg.MergeSpec(("id",), "gone")

TARGET = "id long, v long, only_target string, gone boolean"
STAGED = "id long, v long, gone boolean"

CASES = [  # (id, v, gone): matched 1-3, unmatched 4-6
    (1, 10, True),
    (2, 20, False),
    (3, 30, None),
    (4, 40, True),
    (5, 50, False),
    (6, 60, None),
]


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([(i, i, f"t{i}", None) for i in (1, 2, 3, 9)], TARGET)


@pytest.fixture()
def staged(spark):
    return spark.createDataFrame(CASES, STAGED)


def content(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_truth_table(target, staged):
    got = {r["id"]: (r["v"], r["only_target"]) for r in mg.merge(target, staged, KEY).collect()}
    assert got == {
        2: (20, "t2"),  # matched, FALSE: updated, target-only column kept
        3: (30, "t3"),  # matched, NULL: updated
        5: (50, None),  # unmatched, FALSE: inserted
        6: (60, None),  # unmatched, NULL: inserted
        9: (9, "t9"),  # not staged: kept
    }


def test_recorded_counts_miss_null_flags(target, staged):
    row = mg.change_counts(target, staged, KEY).first()
    assert tuple(row) == (1, 1, 1)


def test_effect_counts(target, staged):
    assert mg.effect_counts(target, staged, KEY).first().asDict() == {
        "inserted_rows": 2,
        "updated_rows": 2,
        "deleted_rows": 1,
        "ignored_rows": 1,
    }


def test_row_sets(target, staged):
    assert content(mg.rows_to_insert(target, staged, KEY), "id") == [(5,)]
    assert content(mg.rows_to_update(target, staged, KEY), "id") == [(2,)]
    assert content(mg.rows_to_delete(target, staged, KEY), "id") == [(1,)]


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("timestamp_ntz", (datetime(2024, 1, 1), None)),
        ("string", ("true", "no idea")),
        ("int", (1, 0)),
    ],
)
def test_flag_types(spark, kind, values):
    staged = spark.createDataFrame([(1, 1, values[0]), (2, 2, values[1])], f"id long, v long, gone {kind}")
    target = staged.filter("false")
    assert content(mg.merge(target, staged, KEY), "id") == [(2,)]


def test_case_of_names_does_not_matter(spark, target):
    staged = spark.createDataFrame([(1, 10, True), (2, 20, False)], "ID long, V long, GONE boolean")
    got = mg.merge(target, staged, KEY)
    assert got.columns == ["id", "v", "only_target", "gone"]
    assert content(got, "id", "v") == [(2, 20), (3, 3), (9, 9)]


def test_source_only_column_is_added(spark, target):
    staged = spark.createDataFrame([(1, 10, False, "new")], "id long, v long, gone boolean, extra string")
    got = mg.merge(target, staged, KEY)
    assert got.columns[-1] == "extra"
    assert content(got.filter("id in (1, 2)"), "id", "extra") == [(1, "new"), (2, None)]


def test_types_of_the_target_win(spark, target):
    staged = spark.createDataFrame([(1, "77", False)], "id int, v string, gone boolean")
    got = mg.merge(target, staged, KEY)
    assert got.schema["v"].dataType == target.schema["v"].dataType
    assert got.filter("id = 1").first()["v"] == 77


def test_composite_key_compares_all_columns(spark):
    spec = mg.MergeSpec(("a", "b"))
    target = spark.createDataFrame([(1, 1, "x"), (2, 1, "y")], "a long, b long, v string")
    staged = spark.createDataFrame([(2, 1, "z"), (2, 2, "n")], "a long, b long, v string")
    assert content(mg.merge(target, staged, spec), "a", "b", "v") == [(1, 1, "x"), (2, 1, "z"), (2, 2, "n")]


def test_duplicate_keys_are_refused(spark, staged):
    mg.require_unique(staged, ["id"])
    with pytest.raises(ValueError, match="not unique"):
        mg.require_unique(staged.unionByName(staged.limit(1)), ["id"])


def test_latest_per_key(spark):
    rows = [(1, datetime(2024, 1, 1), "old"), (1, datetime(2024, 1, 2), "new"), (2, None, "only")]
    df = spark.createDataFrame(rows, "id long, at timestamp_ntz, v string")
    assert content(mg.latest_per_merge_key(df, ["id"], "at"), "id", "v") == [(1, "new"), (2, "only")]


def test_key_is_required():
    with pytest.raises(ValueError):
        mg.MergeSpec(())


def test_broadcast_bound():
    assert mg.broadcast_safe(1_000_000, 24_000_000)
    assert not mg.broadcast_safe(1_000_000_000, 8_000_000_000)


def test_measured_keys_are_broadcast_and_others_left_to_spark(spark, tmp_path, target, staged):
    target.write.parquet(f"{tmp_path}/t")
    staged.write.parquet(f"{tmp_path}/s")
    t, s = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = mg.merge(t, s, mg.MergeSpec(("id",), "gone", broadcast_keys=True))
        big = mg.merge(t, s, KEY)
        plan = small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        assert "BroadcastHashJoin" not in big._jdf.queryExecution().executedPlan().toString()
        assert content(small, "id", "v") == content(big, "id", "v")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


row = hs.tuples(hs.integers(0, 99), hs.sampled_from([True, False, None]))
batch = hs.dictionaries(hs.integers(0, 6), row, max_size=6)


def model(state: dict, staged: dict) -> dict:
    out = dict(state)
    for key, (value, gone) in staged.items():
        if gone is True:
            out.pop(key, None)
        else:
            out[key] = value
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(start=hs.dictionaries(hs.integers(0, 6), hs.integers(0, 99), max_size=6), batches=hs.lists(batch, min_size=1, max_size=2))
def test_chain_of_batches_equals_model(spark, start, batches):
    frame = lambda d: spark.createDataFrame([(k, v, g) for k, (v, g) in d.items()], STAGED)
    live = spark.createDataFrame([(k, v, None) for k, v in start.items()], STAGED)
    state = start
    for one in batches:
        live = mg.merge(live, frame(one), KEY)
        state = model(state, one)
    assert {r["id"]: r["v"] for r in live.collect()} == state
    again = mg.merge(live, frame(batches[-1]), KEY)
    assert content(again, "id", "v") == sorted(state.items())
