"""Runs of words against a search over all periods and places."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.llm import periodic_runs as pr


def plain_runs(words):
    """start, length, period of every run: for each period, stretches of words equal to those a period later."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, *sha)


def in_tiles(ids):
    by: dict[int, list] = {}
    for low, step, first, left, bits, some in pr.tiles(np.array(ids, np.int32), pr._Hashes()):
        for q, start, stop in pr.fragments(low, step, first, left, bits, some.tolist()):
            by.setdefault(q, []).append((start, stop))
    found = []
    for q, parts in by.items():
        parts.sort()
        held = list(parts[0])
        for start, stop in [*parts[1:], (1 << 60, 1 << 60)]:
            if start <= held[1]:
                held[1] = max(held[1], stop)
            else:
                if held[1] - held[0] + q >= max(12, 2 * q):
                    found.append((held[0], held[1] - held[0] + q, q))
                held = [start, stop]
    return sorted(found)


PART = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 6))


@settings(max_examples=150, deadline=None)
@given(st.lists(PART, max_size=5), st.integers(0, 20))
def test_tiles_find_every_run(parts, cut):
    ids = [x for block, times in parts for x in block * times][: 300 - cut]
    assert in_tiles(ids) == sorted(plain_runs(ids))


@pytest.mark.parametrize("n", [11, 12, 13, 31, 64, 500])
def test_one_word_only(n):
    assert in_tiles([0] * n) == ([(0, n, 1)] if n >= 12 else [])


def test_long_periods():
    rng = random.Random(5)
    for q in (7, 8, 15, 16, 17, 31, 32, 100, 255, 256):
        block = [rng.randrange(50) for _ in range(q)]
        ids = [rng.randrange(50, 99) for _ in range(rng.randrange(40))] + (block * 3)[: 2 * q + rng.randrange(q)] + [99]
        if len(ids) < 900:
            assert in_tiles(ids) == sorted(plain_runs(ids))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=1, max_size=30))
def test_z_function(x):
    want = [next((k for k in range(len(x) - i) if x[k] != x[i + k]), len(x) - i) for i in range(len(x))]
    assert pr.z_function(x, len(x))[1:] == want[1:]


def test_equal_hashes_do_not_make_runs(monkeypatch):
    monkeypatch.setattr(pr._Hashes, "steps", lambda self, prefixes, step: np.zeros(len(prefixes) - step, np.uint64))
    ids = [0, 1, 2] * 6 + list(range(3, 40))
    assert in_tiles(ids) == sorted(plain_runs(ids))


def check(spark, rows):
    got = pr.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, key string, period int")).collect()
    assert sorted(map(tuple, got), key=str) == sorted((row(*r[:2]) for r in rows), key=str)


def test_documents(spark):
    rng = random.Random(3)
    line = " ".join(f"w{rng.randrange(9)}" for _ in range(8))
    texts = [None, "", " \t\n", "a " * 11, "a " * 12, "a b\x1cc " * 20, (line + "\n") * 3, "x " + (line + " y\n") * 5 + "z"]
    texts += [" ".join(rng.choice(["k", "l", "mm"]) for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    texts += [" ".join(f"v{rng.randrange(500)}" for _ in range(800))]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts * 2)] + [(None, texts[6], None, None)] + [(6, texts[6], "y", 2)] * 2
    check(spark, rows)


def test_altered_documents(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:20]
    rng = random.Random(9)
    check(spark, [(i, " ".join(f"v{rng.randrange(3 + i)}" for _ in range(3 * i + 1)), "k", 0) for i in ids])


def test_empty_table(spark):
    assert pr.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_long_text(spark):
    rng = random.Random(1)
    block = " ".join(f"v{rng.randrange(4000)}" for _ in range(30_000))
    (got,) = pr.periodic_runs(spark.createDataFrame([(1, f"{block} {block} {block} end")], "doc_id long, text string")).collect()
    assert (got.n_runs, got.start, got.length, got.period, got.exponent_milli) == (1, 0, 90_000, 30_000, 3000)
