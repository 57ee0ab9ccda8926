"""Each stage of the pipeline against a brute-force version of it, over the smallest tables."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import duckdb
import public_tokenizers
import pytest

import corpus_pipeline as pipeline
from tablesync.llm import toxicity
from tablesync.llm.common import held_out, table
from tablesync.llm.queries import MIXED_SQL
from tests.llm.test_near_dedup import brute_classes
from tests.llm.test_tokens import want

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What goes into each stage, and what the last returns."""
    at, found = tmp_path_factory.mktemp("stages"), [table(spark, SF_DIR, "documents")]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, found[-1], SF_DIR).write.parquet(f"{at}/{k}")
        found.append(spark.read.parquet(f"{at}/{k}"))
    return found


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[1:-1])
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]


def test_toxic_documents_go(spark, steps):
    model = toxicity.fit(steps[0], table(spark, SF_DIR, "labels").where(~held_out()))
    both = model.compressors()
    kept = [r.doc_id for r in steps[0].collect() if toxicity._scores(model, [r.text or ""], *both)[0] < 0.5]
    assert ids(steps[1]) == Counter(kept) and len(kept) < steps[0].count()


def test_one_of_equal_texts_stays(steps):
    best = {}
    for r in steps[1].collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[key] = min(best.get(key, (1, 0)), (-len(r.text or ""), r.doc_id))
    assert ids(steps[2]) == Counter(d for _, d in best.values())


def test_one_of_near_copies_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    assert ids(steps[3]) == Counter(set(brute_classes(rows, 0.8).values()))


def test_sources_meet_their_weights(steps, tmp_path):
    steps[3].write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW d0 AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    assert ids(steps[4]) == Counter(r[0] for r in con.execute(MIXED_SQL.format(docs="d0", columns="d.doc_id")).fetchall())


def test_every_id_is_packed_once(steps):
    docs, pieces = steps[4].collect(), steps[5].collect()
    encoded = want(public_tokenizers.path("word_bpe_49k.json"), [r.text or "" for r in docs])
    assert sum(p.length for p in pieces) == sum(map(len, encoded))
    tokens = Counter()
    for p in pieces:
        tokens[p.doc_id] += p.length
    wanted = Counter()
    for r, e in zip(docs, encoded):
        wanted[r.doc_id] += len(e)
    assert tokens == wanted
    sizes = Counter()
    for p in pieces:
        sizes[p.sequence_id] += p.length
    assert all(4096 - n < 16 or n & (n - 1) == 0 for n in sizes.values())


def test_run_is_all_stages(spark, steps):
    got = pipeline.run(spark, SF_DIR)
    assert got.columns == steps[5].columns and got.groupBy().sum("length").first()[0] == steps[5].groupBy().sum("length").first()[0]
