"""Ids gathered from pieces against the library's ids of whole texts; the coder's round trip."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablesync.llm.binary_ids import id_digests, pack_ids, unpack_ids, write_ids
from tablesync.llm.tokens import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = st.sampled_from(list("aZ's,.!9 \n\t\x0b\x1c\x85\xa0'’éÉéH̱<|>Σσςİß中　ñ%-_") + ["<|endoftext|>", "don't", "I'LL", "'s", "x'sam"])


@lru_cache
def library(path):
    return Tokenizer.from_file(path)


def want(path, texts, end=2):
    got = library(path).encode_batch_fast(texts, add_special_tokens=False)
    return [e.ids + [end] for e in got]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(ODD, max_size=30).map("".join), st.text(max_size=40)), min_size=1, max_size=5))
def test_pieces_give_the_librarys_ids(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [x.tolist() for x in encoder(PATH, 2).encode([t.encode() for t in texts])] == want(PATH, texts)


def test_other_tokenizers_get_whole_texts():
    texts = ["Hello  there, it's\n9", "", "é <|endoftext|>"]
    assert not encoder(BYTES, 2).cut
    assert [x.tolist() for x in encoder(BYTES, 2).encode([t.encode() for t in texts])] == want(BYTES, texts)


def test_long_texts_and_a_full_cache():
    rng = np.random.default_rng(1)
    text = " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(200_000)) * 4
    assert encoder(PATH, 2).encode([text.encode(), b"a"])[0].tolist() == want(PATH, [text])[0]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_coding_round_trip(values):
    control, data = pack_ids(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert unpack_ids(control, data, len(values)).tolist() == values


@pytest.mark.parametrize("path", [PATH, BYTES])
def test_files_give_back_every_id(spark, tmp_path, path):
    rows = [(7, "b b b the the", "x"), (None, "null id", "x"), (3, None, "x"), (3, "tie", "x"), (3, "tie", "x"), (9, "", "x"), (1, "é " * 70_000, "x"), (2**40, "don't", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)
    write_ids(docs, str(tmp_path / "f"), path, 2)
    got = id_digests(spark, str(tmp_path / "f")).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = want(path, [r[1] or "" for r in order])
    start = np.cumsum([0] + [len(x) for x in ids])[:-1].tolist()
    crc = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert [tuple(r) for r in got] == [(o[0], s, len(x), c) for o, s, x, c in zip(order, start, ids, crc)]


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    write_ids(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "e"), PATH, 2)
    assert id_digests(spark, str(tmp_path / "e")).count() == 0


def test_packed_ids_of_all_widths():
    from tablesync.llm.binary_ids import LENGTHS

    for values in ([], [0], [255, 256, 7], [65535, 65536, 1, 2, 1 << 24, (1 << 32) - 1], list(range(250, 260)) * 9):
        control, data = pack_ids(np.array(values, np.uint32))
        assert unpack_ids(control, data, len(values)).tolist() == values
        assert len(data) == LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[: len(values)].sum()


def test_ids_of_a_slice_are_flat():
    import pyarrow as pa

    from tablesync.llm.binary_ids import _flat

    rows = [np.arange(k, dtype="<u2").tobytes() for k in range(6)]
    ids, edges = _flat(pa.array(rows, pa.binary()).slice(2, 3), "<u2")
    assert ids.tolist() == [0, 1, 0, 1, 2, 0, 1, 2, 3] and edges.tolist() == [0, 2, 5, 9]
    assert _flat(pa.array([], pa.binary()), "<u4")[0].tolist() == []


def test_digests_are_made_where_blocks_are_decoded(spark, tmp_path):
    from tablesync.llm.queries import vocabulary

    docs = spark.createDataFrame([(n, "some words " * n) for n in range(9)], "doc_id long, text string")
    write_ids(docs, f"{tmp_path}/ids", vocabulary(), 2)
    digests = id_digests(spark, f"{tmp_path}/ids")
    assert digests._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert digests.count() == 9
