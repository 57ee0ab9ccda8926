"""Held-out accuracy and edge cases of the toxicity score."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tablesync.llm import toxicity as tox

CALM = [a + b for a in ("ran", "lo", "mi", "ster", "pol") for b in ("den", "ka", "ring", "tu", "vel", "sh")]


def text(rng, bad):
    words = [rng.choice(CALM) for _ in range(rng.randint(30, 200))]
    for _ in range(max(2, len(words) // 25) if bad else 0):
        words[rng.randrange(len(words))] = rng.choice(["Scumbag!", "vermin,", "trash"])
    return " ".join(words)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    rows = [(k, text(rng, k % 5 == 0), int(k % 5 == 0)) for k in range(600)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_held_out_rows_are_told_apart(spark, data):
    model = tox.fit(data, data.where("doc_id < 400"))
    got = tox.score(data.where("doc_id >= 400"), model).join(data, "doc_id").toPandas()
    assert (got.predicted == got.toxic).mean() > 0.95
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert any(b"scumbag" in s for s in model.strings)


def test_odd_rows_have_scores(spark, data):
    model = tox.fit(data, data)
    rows = [(None, None, "a"), (1, "", "a"), (1, "", "a"), (2, "é" * 50_000, None), (3, "scumbag vermin trash " * 9000, "x"), (4, "!!! \n", "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(2)
    got = {(r.doc_id, r.score) for r in tox.score(odd, model).collect()}
    assert len(got) == 5 and min(s for _, s in got) >= 0
    kept = tox.keep_clean(odd, model)
    assert kept.schema == odd.schema
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 1), (False, 2), (False, 4), (True, 0)]


def test_without_labels_nothing_is_toxic(spark, data):
    model = tox.fit(data, data.where("toxic = 1"))
    assert {r.score for r in tox.score(data, model).collect()} == {0.0}
    assert tox.score(data.limit(0), tox.fit(data, data.limit(0))).count() == 0


def test_windows_cover_the_text():
    words = tox.plain("One, two  three four five")
    start, length = tox.windows(words, 2)
    assert [words[s : s + n] for s, n in zip(start, length)] == [b" one two ", b" three four ", b" five "]
    assert tox.evidence([b" ", b""], *tox.Model(b"abc", [b"x"]).compressors(), 2).tolist() == np.zeros((2, 4)).tolist()


def test_the_base_is_trained_on_pieces_of_all_texts(monkeypatch):
    from tablesync.llm import toxicity

    seen = []
    monkeypatch.setattr(toxicity.zstandard, "train_dictionary", lambda size, samples, **_: seen.extend(samples) or toxicity.zstandard.ZstdCompressionDict(b"x" * 99))
    texts = [f"text {k:04d} ".encode() * 40 for k in range(500)]
    toxicity._base(texts, 1024, 600)
    assert len(seen) <= 600 and b"0000" in seen[0] and any(b"049" in s for s in seen[-6:])


def test_each_row_has_the_score_of_its_text_alone(data):
    model = tox.fit(data, data)
    both = model.compressors()
    want = {r.doc_id: tox._scores(model, [r.text], *both)[0] for r in data.collect()}
    got = {r.doc_id: r.score for r in tox.score(data.repartition(5), model).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_columns_of_any_name_stay(spark, data):
    model = tox.fit(data, data)
    odd = spark.createDataFrame([(1, "calm", 5, 6)], "doc_id long, text string, whole int, WHOLE_ int")
    assert [tuple(r) for r in tox.keep_clean(odd, model).collect()] == [(1, "calm", 5, 6)]
