"""Every registered query against its SQL counterpart."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry
from tests.oracle import compare, connect
from workload.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toArrow()
    want = con.execute(ORACLES[name]).to_arrow_table()
    assert compare(got, want) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
