"""Limits, coverage and padding of packed sequences."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.llm.packing import Example, Limits, Packer, pack
from tests.llm.test_tokens import want

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = Limits(tokens=64, segments=4, loss=40, least=4)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 250)), max_size=40), st.integers(0, 300))
def test_limits_hold_and_every_token_has_one_place(sizes, waiting):
    packer, got = Packer(SMALL), []
    for k, (n, prompt) in enumerate(sizes):
        packer.add([Example(k, 0, n, prompt)])
        got += packer.sequences(waiting)
    got += packer.sequences()
    spans = defaultdict(list)
    for s in got:
        n = sum(e.length for e in s)
        assert s and n <= SMALL.tokens and len(s) <= SMALL.segments and sum(e.loss for e in s) <= SMALL.loss
        assert SMALL.tokens - n < SMALL.least or n & (n - 1) == 0
        for e in s:
            spans[e.key].append((e.start, e.length))
    for k, (n, _) in enumerate(sizes):
        at = 0
        for start, length in sorted(spans[k]):
            assert start == at and length > 0
            at += length
        assert at == n


def test_a_sequence_short_of_segments_takes_long_examples():
    packer = Packer(Limits(tokens=100, segments=2, loss=100, least=1))
    packer.add([Example(k, 0, n) for k, n in enumerate([10, 10, 10, 90, 90, 90])])
    assert [sum(e.length for e in s) for s in packer.sequences()] == [100, 100, 100]


@pytest.mark.parametrize("pool", [1 << 8, 1 << 18])
def test_pieces_of_documents(spark, pool):
    rows = [(k, "w%d the of " % k * (k % 37), "x") for k in range(300)] + [(None, None, "y"), (5, "", "y"), (5, "", "y"), (6, "long word " * 20_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset string").repartition(3)
    got = pack(docs, PATH, 2, pool=pool, with_ids=True).collect()
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == np.cumsum([0] + [r.length for r in s])[:-1].tolist()
    full = [sum(r.length for r in s) for s in sequences.values()]
    assert all(4096 - n < 16 or n & (n - 1) == 0 for n in full)
    whole = {r[0]: want(PATH, [r[1] or ""])[0] for r in rows if r[0] not in (5, 6)}
    for doc_id, wanted in whole.items():
        pieces = sorted((r.start, bytes(r.ids)) for r in got if r.doc_id == doc_id)
        assert np.frombuffer(b"".join(p for _, p in pieces), "<u4").tolist() == wanted
        assert {r.doc_tokens for r in got if r.doc_id == doc_id} == {len(wanted)}
    assert sum(r.length for r in got) == sum(len(x) for x in want(PATH, [r[1] or "" for r in rows]))


def test_an_empty_table_has_no_pieces(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH, 2).count() == 0
