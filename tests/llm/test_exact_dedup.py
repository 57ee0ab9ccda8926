"""The trie against a dictionary, with and without spilling; groups against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.llm.exact_dedup import exact_groups, keep_owners
from tablesync.llm.trie import Trie, preferred

KEY = st.one_of(st.binary(max_size=12), st.lists(st.sampled_from([b"ab", b"abc", b"a" * 40, b"\x00", b"b"]), max_size=6).map(b"".join))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(KEY, st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))), max_size=60), st.sampled_from([1 << 20, 3000, 1200]))
def test_trie_holds_each_string_once(items, budget):
    trie, want = Trie(budget), {}
    for key, most, owner in items:
        value = (most, owner, 1, 1)
        trie.insert(key, value)
        want[key] = preferred(want[key], value) if key in want else value
    spilled = bool(trie.spilled)
    got = list(trie.digests() if spilled else trie.strings())
    if spilled:
        want = {hashlib.sha256(k).hexdigest(): v for k, v in want.items()}
    assert len(got) == len(want) and dict(got) == want


ROWS = [(1, "a b", "x"), (2, "ab", "x"), (3, "a  b", None), (4, None, "x"), (5, " \n", "y"), (6, "c\x1cd", "y"), (7, "cd", "y"), (8, "c d", "y"), (9, "é é", "z"), (10, "éé", "z"), (11, "long " * 50_000, "z"), (12, "long" * 50_000, "z"), (None, "only null id", "z"), (None, "q", "z"), (13, "q", "z")]


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id))
    out = set()
    for norm, found in groups.items():
        keep = min(found, key=lambda f: (f[0], f[1], f[2] or 0))[2]
        out.update((f[2], keep, len(found), f[2] == keep, hashlib.sha256(norm.encode()).hexdigest()) for f in found)
    return out


@pytest.mark.parametrize("budget", [192 << 20, 4000])
def test_groups(spark, budget):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, sha string").repartition(4)
    assert {tuple(r) for r in exact_groups(docs, budget=budget).collect()} == brute(ROWS)


def test_owners_keep_their_rows(spark):
    rows = ROWS + [(1, "a b", "x"), (3, "a  b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, owner string")
    kept = keep_owners(docs)
    assert kept.columns == docs.columns
    want = {r[0] for r in brute(ROWS) if r[3]}
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, want))


def test_empty(spark):
    assert exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_of_one_identifier_the_longer_text_stays(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (1, "ab", 2), (2, "c", 3), (2, "c ", 4), (2, " c", 5)], "doc_id long, text string, key int")
    assert {(r.doc_id, r.kept, r.group_size) for r in exact_groups(docs.limit(2)).collect()} == {(1, True, 2), (1, False, 2)}
    assert sorted(tuple(r) for r in keep_owners(docs).collect()) == [(1, "a b", 1), (2, " c", 5)]


def test_rows_pass_by_the_marks_and_through_the_join(spark, monkeypatch):
    monkeypatch.setattr("tablesync.llm.exact_dedup.MARKS", 2)
    rows = [(k, f"t{k % 70}", "m", True) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string, repeated boolean")
    assert sorted(r.doc_id for r in keep_owners(docs).collect()) == list(range(70))
