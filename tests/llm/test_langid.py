"""Back-off, held-out accuracy and edge cases of language identification."""

from __future__ import annotations

import random

import pytest

from tablesync.llm import langid

WORDS = {"aa": ["the", "house", "river", "stone", "bright"], "bb": ["das", "haus", "fluss", "stein", "licht"], "cc": ["la", "maison", "rivière", "pierre", "lumière"]}


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choices(WORDS[lang], k=rng.randint(3, 30))), lang) for k, lang in enumerate(list(WORDS) * 60)]
    return spark.createDataFrame([*rows, (900, "the house", None), (901, None, "aa")], "doc_id long, text string, lang string")


def test_unseen_words_back_off_to_shorter_grams(data):
    model = langid.fit(data)
    assert model.languages == ["aa", "bb", "cc"]
    assert model.languages[int(model.word("rivières").argmax())] == "cc"  # shares long n-grams
    assert model.languages[int(model.word("xhausx").argmax())] == "bb"
    assert model.word("中").tolist() == [0, 0, 0]
    assert set(map(len, model.known[1])) == {5} and set(map(len, model.known[5])) == {1}


def test_held_out_rows(spark, data):
    model = langid.fit(data.where("doc_id < 100"))
    rows = langid.predict(data.where("doc_id >= 100 AND doc_id < 900"), model).join(data, "doc_id").toPandas()
    assert (rows.lang_pred == rows.lang).all() and rows.score.between(0, 1).all()


def test_odd_rows(spark, data):
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 !? 34", None), (3, "12 !? 34", None), (4, "中文", "x"), (5, "the haus " * 40_000, "x"), (None, "fluss stein", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string").repartition(2)
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(data)).collect()}
    assert {got[k].lang_pred for k in (1, 2, 3)} == {"und"} and {got[k].score for k in (1, 2, 3)} == {0.0}
    assert got[4].lang_pred == "aa" and got[None].lang_pred == "bb"
    assert langid.predict(docs, langid.fit(data)).count() == 7


def test_without_languages_everything_is_unknown(spark, data):
    model = langid.fit(data.limit(0))
    assert {(r.lang_pred, r.score) for r in langid.predict(data, model).collect()} == {("und", 0.0)}
    assert langid.predict(data.limit(0), model).count() == 0


def test_languages_of_long_texts_are_learned(spark):
    rng = random.Random(7)
    long = [(k, " ".join(rng.choices(WORDS["bb"], k=6000)), "bb") for k in range(20)]
    short = [(100 + k, " ".join(rng.choices(WORDS["aa"], k=9)), "aa") for k in range(20)]
    labelled = spark.createDataFrame(long + short, "doc_id long, text string, lang string")
    for settings in (langid.Settings(), langid.Settings(language_bytes=1000)):
        model = langid.fit(labelled, settings)
        assert model.languages == ["aa", "bb"] and model.languages[int(model.word("haus").argmax())] == "bb"


def test_many_languages_share_the_cells(spark):
    rows = [(k, f"w{k % 50}x{i} " * 3, f"l{k % 50:02d}") for k in range(200) for i in range(4)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langid.Settings(cells=50 * 50 * 3))
    assert len(model.languages) == 50 and all(len(t) <= 150 for t in model.known)


def test_predictions_against_plain_sums(data):
    """Each word's evidence added up one by one."""
    model = langid.fit(data)
    for r in langid.predict(data, model).join(data, "doc_id").where("text IS NOT NULL").collect():
        sums = [sum(float(model.word(w)[k]) for w in langid.words(r.text)) for k in range(len(model.languages))]
        assert abs(max(sums) - sums[model.languages.index(r.lang_pred)]) < 1e-9
