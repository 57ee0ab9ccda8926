"""Archives read back as written, their records by the letter, and the merged index against a plain sort."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.llm.warc import LoserTree, capture_index, members, parsed, url_key, write_archives

SCHEMA = "page_id long, url string, html string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def indexed(spark, rows, tmp_path, schema=SCHEMA, **settings):
    path = f"file://{tmp_path}/archives"
    write_archives(spark.createDataFrame(rows, schema), path, **settings)
    return capture_index(spark, path).orderBy("part", "place").collect()


def records(tmp_path):
    for name in glob.glob(f"{tmp_path}/archives/part-*"):
        with open(name, "rb") as file:
            data = file.read()
        for at, length, record in members(data):
            assert gzip.decompress(data[at : at + length]) == record
            if record:
                yield name, at, length, *parsed(record)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=6).map(sorted), max_size=9))
def test_loser_tree_merges(slices):
    got = [(slices[s][k], s, k) for s, k in LoserTree(slices)]
    assert got == sorted((x, s, k) for s, some in enumerate(slices) for k, x in enumerate(some))


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://www.Example.com/A?b=2&a=1#x", "com,example)/a?a=1&b=2"),
        ("https://u:p@a.b.org:443", "org,b,a)/"),
        ("//a.b:8080/x", "b,a:8080)/x"),
        ("mailto:X", "mailto:x"),
        (None, ""),
    ],
)
def test_url_keys(url, key):
    assert url_key(url) == key


def test_pages_come_back(spark, tmp_path):
    rng = random.Random(2)
    bodies = [None, "", "<p>é\r\n\r\nWARC/1.1\r\n</p>", "x" * 300_000, "<b>一</b>"] + [f"<i>{rng.random()}</i>" * 20 for _ in range(60)]
    rows = [(k, f"http://h{k % 3}.example.org/{k % 7}/é b?{k}", bodies[(k * k) % len(bodies)]) for k in range(150, 0, -1)]
    got = indexed(spark, rows, tmp_path, block=4096)
    first = {}
    for page, _, html in sorted(rows):
        first.setdefault(html or "", page)
    want = set()
    for page, _, html in rows:
        body, owner = (html or "").encode(), first[html or ""]
        want.add((page, len(body), digest(body), "response" if owner == page else "revisit", None if owner == page else owner))
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want and len(got) == len(rows)
    keys = [(r.url_key, r.captured, r.page_id) for r in got]
    assert keys == sorted(keys) and len({r.archive for r in got}) > 2


def test_records_by_the_letter(spark, tmp_path):
    rows = [(1, "http://a.example.org/x", "same"), (2, "http://a.example.org/y", "same"), (3, None, "other")]
    got = {r.page_id: r for r in indexed(spark, rows, tmp_path)}
    found = {f["Page-ID"]: (name, at, n, f, block) for name, at, n, f, block in records(tmp_path) if "Page-ID" in f}
    assert found["1"][4].endswith(b"\r\n\r\nsame") and found["2"][4].endswith(b"Content-Length: 4\r\n\r\n")
    assert found["2"][3]["WARC-Refers-To"] == found["1"][3]["WARC-Record-ID"]
    assert "WARC-Target-URI" not in found["3"][3] and got[3].url_key == ""
    for page, (name, at, n, _, _) in found.items():
        assert (got[int(page)].offset, got[int(page)].length, got[int(page)].archive.rsplit("/", 1)[-1]) == (at, n, name.rsplit("/", 1)[-1])
    with gzip.open(next(iter(found.values()))[0]) as whole:
        assert whole.read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_repeated_and_null_identifiers(spark, tmp_path):
    rows = [(5, "http://b.org", "x")] * 3 + [(5, "http://a.org", "x")] * 2 + [(None, "u", "x"), (None, None, "alone"), (None, None, "alone")]
    got = [(r.page_id, r.url, r.record_type, r.refers_to) for r in indexed(spark, rows, tmp_path)]
    want = [(None, None, "response", None), (None, None, "revisit", None), (5, "http://a.org", "response", None), (5, "http://a.org", "revisit", 5)]
    assert sorted(got, key=str) == sorted([*want, *[(5, "http://b.org", "revisit", 5)] * 3, (None, "u", "revisit", 5)], key=str)


def test_small_payloads_are_responses(spark, tmp_path):
    got = indexed(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")], tmp_path, least=3)
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_damaged_archives_are_refused():
    with pytest.raises(ValueError):
        list(members(gzip.compress(b"x" * 1000)[:-9]))


def test_no_pages_and_other_columns(spark, tmp_path):
    assert indexed(spark, [], tmp_path) == []
    more = [(1, "http://a.org", "x", "k", 3, b"s")]
    assert len(indexed(spark, more, tmp_path, SCHEMA + ", key string, n int, sha binary")) == 1


def test_hot_page(spark, tmp_path):
    rows = [(k, "http://one.example.org/", "same" if k % 3 else f"p{k}") for k in range(3000)]
    got = indexed(spark, rows, tmp_path)
    assert sum(r.record_type == "revisit" for r in got) == 1999 and {r.refers_to for r in got} == {None, 1}
    assert [r.page_id for r in got] == list(range(3000))
