"""The pipeline over odd tables: nulls, empty texts, repeated rows, clashing columns, no labels, no rows."""

from __future__ import annotations

import corpus_pipeline as pipeline
from tablesync.llm.common import dropping_scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, row int, mark string, repeated boolean"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"word{k}" for k in range(30_000))


def tables(spark, folder, rows, labels=()):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), LABELS).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def row(doc_id, text, source="a", extra=1):
    return (doc_id, text, None, source, len(text or ""), extra, "k", extra, "m", True)


ROWS = [
    row(1, None), row(2, ""), row(3, " \t"), row(4, "one text"), row(4, "one text"), row(5, "onetext", None), row(None, "no id here"),
    row(None, None), row(6, LONG), row(7, LONG + " more"), row(8, "the last one of all texts in here, ok", "b"), row(9, "é一\n\n" * 50, "b"),
]


def test_each_stage_on_odd_rows(spark, tmp_path):
    folder = tables(spark, tmp_path, ROWS)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    with dropping_scratch(spark):
        found = []
        for k, (_, stage) in enumerate(pipeline.STAGES[:-1]):
            stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
            docs = spark.read.parquet(f"{tmp_path}/{k}")
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
            found.append(sorted((r.doc_id for r in docs.collect()), key=str))
    assert len(found[0]) == len(ROWS)  # without labels nothing is toxic
    # of the blank texts that of most code points stays, of the equal ones the longer, once
    assert found[1] == [3, 4, 6, 7, 8, 9, None]
    assert found[2] == [3, 4, 6, 8, 9, None]
    assert set(found[3]) <= set(found[2])


def test_the_whole_pipeline_on_odd_rows(spark, tmp_path):
    with dropping_scratch(spark):
        got = pipeline.run(spark, tables(spark, tmp_path, ROWS)).collect()
    assert got and {r.doc_id for r in got} <= {3, 4, 6, 8, 9, None}


def test_no_documents(spark, tmp_path):
    with dropping_scratch(spark):
        assert pipeline.run(spark, tables(spark, tmp_path, [])).count() == 0
