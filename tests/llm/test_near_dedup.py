"""Classes against all pairs by brute force; components against union-find."""

from __future__ import annotations

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.llm import near_dedup
from tablesync.llm.common import Scratch
from tablesync.llm.components import components
from tablesync.llm.near_dedup import Frequent, keep_representatives, near_classes


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def brute_classes(rows, similar):
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(r[0], shingles(r[1])) for r in rows]
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if len(s & t) >= similar * len(s | t):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {r[0]: find(r[0]) for r in rows}


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(3000)]
    passage = rng.choices(vocabulary, k=40)
    rows = []
    for k in range(120):
        words = rng.choices(vocabulary, k=rng.randint(60, 300))
        if k % 3 == 0:
            words[10:10] = passage
        rows.append(words)
    for k in range(120):  # chains of near copies
        words = list(rows[rng.randrange(len(rows))])
        for _ in range(max(1, len(words) // 120)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append(words)
    rows += [rows[3]] * 5
    return [(1000 - 3 * k, " ".join(w), "x") for k, w in enumerate(rows)]


def test_classes_are_those_of_all_pairs(spark):
    rows = made(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(5)
    got = near_classes(docs).toPandas()
    want = brute_classes(rows, 0.8)
    assert dict(zip(got.doc_id, got.class_id)) == want
    assert (got.kept == (got.doc_id == got.class_id)).all()
    sizes = got.groupby("class_id").doc_id.count()
    assert (got.class_size == got.class_id.map(sizes)).all() and len(got) == len(rows)
    kept = keep_representatives(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_odd_rows(spark):
    long = " ".join("v%d" % k for k in range(30_000))
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "A  b!"), (5, long), (6, long + " end"), (None, "alone with no id"), (None, "a b"), (None, "other text")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, id string").repartition(3)
    got = {(r.doc_id, r.class_id, r.class_size, r.kept) for r in near_classes(docs).collect()}
    assert got == {(1, 1, 2, True), (2, 1, 2, False), (3, 3, 4, True), (4, 3, 4, False), (5, 5, 2, True), (6, 5, 2, False), (None, None, 1, True), (None, 3, 4, False)}
    assert near_classes(docs).count() == len(rows)
    kept = [(r.doc_id, r.text) for r in keep_representatives(docs).collect()]
    assert len(kept) == 6 and (None, "other text") in kept and (None, "a b") not in kept
    assert near_classes(docs.limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=20), max_size=10), st.integers(2, 12))
def test_summary_holds_what_is_frequent(parts, size):
    found = Frequent(size)
    for p in parts:
        found.add(*np.unique(np.array(p, np.uint64), return_counts=True))
    every = [x for p in parts for x in p]
    held = dict(zip(found.values.tolist(), found.counts.tolist()))
    assert len(held) <= size and found.lost <= len(every) / size
    for x in set(every):
        assert every.count(x) - found.lost <= held.get(x, 0) <= every.count(x)


def bucket(spark, sizes):
    """Rows of one bucket: classes of these sizes, whose texts agree in band 0 only."""
    rng = np.random.default_rng(3)
    n = sum(sizes)
    got = rng.integers(0, 1 << 32, (n, near_dedup.BANDS * near_dedup.ROWS), np.uint32)
    got[:, : near_dedup.ROWS] = 7
    label = np.repeat(np.arange(len(sizes)), sizes)
    return got, lambda: spark.createDataFrame([(int(near_dedup.band_keys(got)[0, 0]), k, int(label[k]), bytearray(got[k].tobytes())) for k in range(n)], "key long, id long, label long, samples binary")


def test_no_group_holds_more_than_two_blocks(spark):
    sizes = [1500, 300, *[1] * 700]
    rows = near_dedup._block_pairs(bucket(spark, sizes)[1]()).select("pair", "side", "id", "label").collect()
    label, met, held = {}, set(), {}
    for r in rows:
        label[r.id] = r.label
        held.setdefault(r.pair, []).append(r)
    assert max(len(h) for h in held.values()) < 3 * near_dedup.BLOCK
    for h in held.values():
        met |= {(min(a.id, b.id), max(a.id, b.id)) for a in h for b in h if a.label != b.label and (a.side != b.side or a.side == near_dedup.BOTH)}
    n = sum(sizes)
    assert len(met) == (n * n - sum(k * k for k in sizes)) // 2


def test_pairs_that_share_one_large_bucket_only_are_compared(spark):
    got, frame = bucket(spark, [1] * 600)
    got[599] = got[0]
    got[599, near_dedup.ROWS :: near_dedup.ROWS] += 1  # one sample of each other band differs
    held = near_dedup._block_pairs(frame()).repartition("pair").sortWithinPartitions("pair")
    kinds = "pair long, key long, side int, id long, label long, samples binary"
    assert sorted(r.id for r in held.mapInArrow(near_dedup._with_partners, kinds).collect()) == [0, 599]


def test_components(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    links = [(min(e), max(e)) for e in links]
    nodes = spark.range(0, 210)
    edges = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.label for r in components(nodes, edges, Scratch(spark, "test"), "c").collect()}
    parent = {k: k for k in range(210)}
    for _ in range(210):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent


def test_rows_of_a_bucket_grow_with_its_texts(spark):
    counts = [near_dedup._block_pairs(bucket(spark, [1] * n)[1]()).count() for n in (500, 2000)]
    assert counts == [500, 2000]


def test_blocks_are_bounded_by_words_too(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_WORDS", 1000)
    got, frame = bucket(spark, [1] * 40)
    rows = near_dedup._block_pairs(frame().selectExpr("*", "100L AS size")).collect()
    sizes = {}
    for r in rows:
        sizes[r.pair] = sizes.get(r.pair, 0) + 1
    assert len(rows) > 40 and max(sizes.values()) <= 40


def test_tasks_keep_rare_shingles_to_themselves(spark):
    words = [(list(range(k * 100, k * 100 + 50)),) for k in range(600)] + [([1, 2, 3, 4, 5],)] * 30
    frame = spark.createDataFrame(words, "words array<long>").coalesce(1)
    rows = frame.mapInArrow(near_dedup._candidates(100_000, 1 / 300), "shingle long, n long").collect()
    assert sorted(r.n for r in rows if r.shingle is not None) == [31] and [r.n for r in rows if r.shingle is None] == [2]


def test_stars_of_many_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "STAR", 3)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    rows = [(k, " ".join([*base[:50], f"x{k}", *base[51:]]), "a") for k in range(40)]
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string, part string")).collect()
    assert {(r.class_id, r.class_size) for r in got} == {(0, 40)}


def test_large_classes_have_their_sizes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LARGE_CLASS", 5)
    rows = [(k, "the same words in each of them" if k % 2 else f"one two three four {k // 8}") for k in range(40)]
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.class_size) for r in got} == {(1, 20)} | {(8 * k, 4) for k in range(5)}


def test_scratch_is_dropped(spark):
    from tablesync.llm.common import dropping_scratch
    from tablesync.plans.files import exists

    with dropping_scratch(spark):
        at = len(Scratch.made)
        docs = spark.createDataFrame([(k, f"text of {k // 2}", k) for k in range(9)], "doc_id long, text string, id int")
        assert sorted(r.doc_id for r in keep_representatives(docs).collect()) == [0, 2, 4, 6, 8]
        roots = [s.root for s in Scratch.made[at:]]
        assert any(exists(spark, r) for r in roots)
    assert roots and not any(exists(spark, r) for r in roots)


def test_shingles_and_samples_are_those_of_plain_steps():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 30, n) if n % 2 else rng.integers(-(1 << 62), 1 << 62, n) for n in (0, 1, 4, 5, 6, 90, 300, 301)]
    s = near_dedup.Shingles(pa.array([t.tolist() for t in texts], pa.list_(pa.int64())))
    pairs = list(zip(s.owner.tolist(), s.hash.tolist()))
    assert pairs == sorted(set(pairs)) and s.first.tolist() == [next(k for k, p in enumerate(pairs) if p[0] == n) for n in range(len(texts))]
    r, ln_c, beta = randoms = near_dedup._randoms()
    got, ln_w = near_dedup.samples(s, s.tf, randoms), np.log(s.tf).astype(np.float32)
    for k in (0, 17, 63):
        slot = ((s.hash ^ np.uint64(k * 0x5851F42D4C957F2D & (1 << 64) - 1)) * near_dedup._MIX >> np.uint64(50)).astype(np.int64)
        t = np.floor(ln_w / r[k, slot] + beta[k, slot])
        ln_a = ln_c[k, slot] - r[k, slot] * (t - beta[k, slot]) - r[k, slot]
        for n, a in enumerate(s.first):
            best = a + int(np.argmin(ln_a[a : np.append(s.first, len(pairs))[n + 1]]))
            chosen = (s.hash[best : best + 1] ^ (t[best : best + 1].astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * near_dedup._MIX
            assert got[n, k] == chosen[0] >> np.uint64(32)


def test_words_are_split_without_interpreted_filters(spark):
    docs = spark.createDataFrame([("  One, two;THREE ",), ("",), ("...",), ("x",)], "text string")
    hashed = docs.select(near_dedup._hashed("text").alias("words"))
    assert "filter(" not in hashed._jdf.queryExecution().optimizedPlan().toString().lower()
    of = lambda *words: [spark.range(1).selectExpr(f"xxhash64('{w}') AS h").first().h for w in words]
    assert [r.words for r in hashed.collect()] == [of("one", "two", "three"), [], [], of("x")]
