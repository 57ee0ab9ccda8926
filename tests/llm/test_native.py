"""Fingerprints by brute force, line dedup and mixing on odd rows, and no Python in their plans."""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash

from tablesync.llm import fingerprints as fp
from tablesync.llm.line_dedup import without_repeats
from tablesync.llm.mixing import mixed, rates

NO_ID = [(None, "no id here at all", "x")]
TEXTS = [(k, " ".join(f"w{(k * i) % 97}" for i in range(k % 60)), "x") for k in range(150)]
ODD = [(200, None, "y"), (201, "", "y"), (202, "Ünï cödé, Wörds! " * 40, None), (203, "a", "y"), (203, "a", "y"), (-5, "long " * 30_000, "y")]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def sketch(text):
    words = [w for w in re.split(r"[^\w]+|_", text.lower()) if w]
    out = []
    for k in range(max(1, len(words) - 4)):
        h = 42
        for w in words[k : k + 5]:
            h = xxhash.xxh64_intdigest(struct.pack("<Q", xxhash.xxh64_intdigest(w.encode(), seed=42)), seed=h)
        out.append(signed(h))
    low = -(1 << 63) + (1 << 64) // fp.KEEP
    return {h for h in out if h < low} | {min(out)}, {h for h in out if h < low}


def like(a, b):
    (x, xl), (y, yl) = sketch(a), sketch(b)
    return len(xl & yl) / min(len(xl), len(yl)) if xl and yl else float(min(x) == min(y))


@pytest.mark.parametrize("per_range", [1, 7, 10_000])
def test_fingerprints_are_those_of_brute_force(spark, per_range):
    rows = TEXTS + ODD
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars string").repartition(4)
    got = Counter(tuple(r) for r in fp.fingerprinted(docs, per_range=per_range).collect())
    order = sorted(rows, key=lambda r: (r[0], r[1] or ""), reverse=True)
    want = Counter()
    for r, after in zip(order, order[1:] + order[:1]):
        text, following = r[1] or "", after[1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        printed = ["".join("%016x" % (h & (1 << 64) - 1) for h in sorted(sketch(t)[0])) for t in (text, edited)]
        want[(r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), *printed, like(text, edited), like(text, following))] += 1
    assert got == want


def test_fingerprints_merge_and_null_ids_are_last(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h", "i j k l m n o p q")], "doc_id long, text string, other string")
    both = fp.with_sketch(fp.with_sketch(docs, "text", "a"), "other", "b").select(fp.union("a", "b").alias("u")).first().u
    x, y = sketch("a b c d e f g h"), sketch("i j k l m n o p q")
    assert set(both) == x[1] | y[1] | {min(x[0] | y[0])}
    rows = [(1, "first", "x"), (None, "null", "x"), (2, "second", "x")]
    got = fp.with_next(spark.createDataFrame(rows, "doc_id long, text string, n string"), "doc_id", "text", ["text"], 1)
    assert {(r.text, r.next_text) for r in got.collect()} == {("second", "first"), ("first", "null"), ("null", "second")}
    assert fp.fingerprinted(docs.limit(0)).count() == 0
    assert fp.fingerprinted(docs).first().near_next == 1.0  # the only text follows itself


def test_repeated_chunks_go_but_for_the_first(spark):
    long = " ".join(f"passage{k}" for k in range(60))
    rows = [(3, f"own line\n{long}\nother own", "x"), (1, f"quite\ndifferent\n{long}", "x"), (2, long, "x"), (4, None, "x"), (5, "", "x"), (6, "\n\n \n", "x"), (7, "\n\n \n", "x"), (8, "short\nshort\nshort", "x"), (None, long, "x"), (9, "l\n" * 20_000, "x"), (1, f"quite\ndifferent\n{long}", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, version string").repartition(3)
    got = defaultdict(list)
    for r in without_repeats(docs).collect():
        got[r.doc_id].append(r)
    assert len(got[1]) == 2 and {r.text for r in got[1]} == {f"quite\ndifferent\n{long}"}
    assert got[3][0].text == "own line\nother own" and got[3][0].n_removed == 1 and got[3][0].removed_chars == len(long) + 1
    assert got[2][0].text == "" and got[None][0].text == "" and got[4][0].text is None and got[5][0].text == "" and got[6][0].text == got[7][0].text == "\n\n \n"
    assert without_repeats(docs.limit(0)).count() == 0


def test_inserted_lines_do_not_shift_later_chunks(spark):
    body = [f"line {k} of the shared body" for k in range(60)]
    docs = spark.createDataFrame([(1, "\n".join(body)), (2, "\n".join(["new", "lines", *body[:30], "and one", *body[30:], "end"]))], "doc_id long, text string")
    got = {r.doc_id: r for r in without_repeats(docs).collect()}
    assert got[1].text == "\n".join(body) and len(got[2].text.split("\n")) < 30
    assert {"new", "lines", "and one", "end"} <= set(got[2].text.split("\n"))


def test_copies_follow_the_rates(spark):
    rows = [(k, "x" * 10, "a" if k % 3 else "b") for k in range(6000)] + [(9000 + k, "y", "tiny") for k in range(40)] + [(1, None, None), (2, "", None), (None, "zzz", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"a": 1.0, "b": 2.0, "tiny": 0.1}
    rate = {r["__source"]: r.rate for r in rates(docs, weights).collect()}
    got = Counter(r.source for r in mixed(docs, weights).collect())
    for source, n in Counter(r[2] for r in rows).items():
        if source:
            assert abs(got[source] - n * rate[source]) < 5 * math.sqrt(n * rate[source])
    assert rate["tiny"] > 32 and rate[None] == 1.0
    again = mixed(docs.repartition(7), weights)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, mixed(docs, weights).collect()))
    assert mixed(docs, {"a": 1.0}).where("source <> 'a'").count() == 0
    assert mixed(docs.limit(0)).count() == 0


def test_no_python_in_the_plans(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, source string").write.mode("overwrite")
    docs.saveAsTable("native_docs")
    held = spark.table("native_docs")
    for df in (fp.fingerprinted(held), without_repeats(held), mixed(held)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
    spark.sql("DROP TABLE native_docs")


def test_texts_without_repeats_are_cut_once(spark, monkeypatch):
    from tablesync.llm import line_dedup

    shared = "\n".join(f"shared line {k} " + "of many words " * 20 for k in range(3))
    rows = [(n, f"only {n}\nsecond {n}\nthird {n}") for n in range(60)] + [(100, f"a\n{shared}"), (101, f"b\n{shared}"), (102, None)]
    docs, cut, plain = spark.createDataFrame(rows, "doc_id long, text string"), [], line_dedup.chunked

    def seen(docs, text="text", *args, **kwargs):
        cut.append(docs.where(f"{text} IS NOT NULL").count())
        return plain(docs, text, *args, **kwargs)

    monkeypatch.setattr(line_dedup, "chunked", seen)
    got = {r.doc_id: r for r in line_dedup.without_repeats(docs).collect()}
    assert cut[0] == 62 and sum(cut[1:]) < 10
    assert got[101].n_removed == 3 and got[101].text == "b" and got[100].n_removed == 0 and got[100].text == f"a\n{shared}"
    assert all(got[n].n_chunks >= 1 and got[n].text == rows[n][1] for n in range(60)) and (got[102].text, got[102].n_chunks) == (None, 0)
