"""Near duplicates by improved consistent weighted sampling of TF-IDF shingles.

Shingles are runs of five words (letters, digits and marks, lower case); a text of fewer words is one shingle. A shingle
weighs ``1 + ln(tf)`` times its IDF. The IDF is ``1`` for a shingle in at most one in ``COMMON`` distinct texts, and falls
with the logarithm of its frequency to ``FLOOR`` for one that all texts have. So only the frequent shingles need a count of
their own, and of these there are at most ``COMMON`` times the mean number of shingles in a text, however large the corpus:
a summary of bounded size finds candidates, a second pass counts them exactly, and the list is broadcast.

1. Exact copies, by hash of the normalised words, become one text: the one of the smallest identifier.
2. ``BANDS * ROWS`` samples of each text: the shingle with the least ``c / (y e^r)`` (Ioffe 2010). Random numbers come from
   a table by hash of the shingle and number of the sample; equal samples agree in shingle and in ``t``.
3. Texts that agree in all samples of a band share a bucket. Each is paired with the bucket's smallest identifier, not
   with every other text. Pairs that agree in at least ``AGREEING`` samples are compared by their shingles; they are a link if
   their weighted Jaccard similarity, or the plain one of their sets of shingles, is 0.8 or more. Samples are weighted, so a pair
   is missed at a rate that its weighted similarity gives: 0.0002 for 0.8, 0.002 for 0.75.
4. Links make classes, by connected components over tables on shared storage.
5. What that leaves are buckets that hold several classes. Within these, texts of different classes are compared by their
   samples, whole at any size: a bucket is dealt into blocks of about ``BLOCK`` texts or ``BLOCK_WORDS`` words, and each pair of
   blocks that may hold two classes meets in a group of its own, so a text goes to as many groups as its bucket has such
   blocks: to one, unless that bucket is larger than a block. Texts with a
   partner of enough equal samples meet once more, with their shingles, and are verified in the task: no pairs leave it but
   the links that join classes, fewer than there are texts. The classes are joined along these.

Null texts count as empty; empty texts are equal. Null identifiers come after all others. Rows of one identifier are one
document: they share its class, by the smaller of their texts where these differ. An empty table gives an empty result. Columns beside identifier and text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import Scratch, batch_parts, dropping_shuffles, maybe_among, unused, whole
from tablesync.llm.components import components

SIZE = 5
COMMON = 256
FLOOR = 0.75
BANDS, ROWS = 16, 4
SIMILAR = 0.8
#: Of ``BANDS * ROWS`` samples, two texts of similarity 0.8 agree in fewer than this once in ten thousand times.
AGREEING = 38
#: Texts of a bucket that meet in one group, from each of its two blocks, and their words.
BLOCK = 4096
BLOCK_WORDS = 1 << 20
#: Texts of a star that are compared with its centre in one group.
STAR = 256
#: Texts of a task that looks for frequent shingles.
TASK_TEXTS = 4096
#: Classes of so many documents, and of one in a million of all, have their sizes broadcast: there are a million at most.
LARGE_CLASS = 1000
#: Identifiers are smaller.
_NO_ID = 1 << 62
_TABLE = 1 << 14
#: The side of rows whose block meets itself.
BOTH = 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hashed(text: str) -> Column:
    """Hashes of the words of a text."""
    words = F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}\p{M}]+")
    return F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))


class Shingles:
    """Distinct shingles of a batch of texts: text number, hash, weight before IDF; sorted by text."""

    def __init__(self, words: pa.ListArray):
        offsets = words.offsets.to_numpy().astype(np.int64)
        flat = words.values.to_numpy(zero_copy_only=False).view(np.uint64)[offsets[0] : offsets[-1]] if len(words.values) else np.zeros(0, np.uint64)
        offsets = offsets - offsets[0]
        count = np.diff(offsets)
        # text k has max(1, count - 4) shingles; short texts are padded with zeros
        padded = np.concatenate((flat, np.zeros(SIZE, np.uint64)))
        n = np.maximum(count - SIZE + 1, 1)
        owner = np.repeat(np.arange(len(count)), n)
        at = np.repeat(offsets[:-1] - (np.cumsum(n) - n), n) + np.arange(len(owner))
        value = np.zeros(len(owner), np.uint64)
        short = np.repeat(count < SIZE, n)
        left = np.repeat(count, n)
        for k in range(SIZE):
            word = padded[np.minimum(at + k, len(padded) - 1)]
            value = (value ^ np.where(short & (k >= left), np.uint64(k), word)) * _MIX
            value ^= value >> np.uint64(31)
        order = np.argsort(value)
        of = owner[order]
        # texts of a batch are few, and numbers of 16 bits are sorted without comparing them
        order = order[np.argsort(of.astype(np.uint16) if len(count) <= 1 << 16 else of, kind="stable")]
        owner, value = owner[order], value[order]
        first = np.ones(len(owner), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
        at = np.flatnonzero(first)
        self.owner, self.hash = owner[at], value[at]
        self.tf = 1 + np.log(np.diff(np.append(at, len(owner))))
        self.first = np.searchsorted(self.owner, np.arange(len(count)))


class Frequent:
    """A Misra-Gries summary: every value that is more than ``total / size`` of what was added is in it."""

    def __init__(self, size: int):
        self.size = size
        self.lost = 0  # most that any count is too small by
        self.values, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        values = np.concatenate((self.values, values))
        distinct, place = np.unique(values, return_inverse=True)
        total = np.bincount(place, np.concatenate((self.counts, counts)), len(distinct)).astype(np.int64)
        if len(total) > self.size:
            least = int(np.partition(total, len(total) - self.size - 1)[len(total) - self.size - 1])
            total = total - least
            self.lost += least
        kept = total > 0
        self.values, self.counts = distinct[kept], total[kept]


def _candidates(size: int, allowance: float):
    """What may be frequent, and in a row without a shingle by how much counts may be too small.

    A task keeps to itself what it has at most ``allowance`` times a text of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, texts = Frequent(size), 0
        for batch in batches:
            for part in batch_parts(batch, 4 << 20):
                texts += part.num_rows
                found.add(*np.unique(Shingles(part.column(0)).hash, return_counts=True))
        few = int(allowance * texts)
        kept = found.counts > few
        shingles = pa.array([None, *found.values[kept].view(np.int64).tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays([shingles, pa.array([found.lost + few, *found.counts[kept].tolist()], pa.int64())], names=["shingle", "n"])

    return run


def _counted(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = wanted.value
        counts = np.zeros(len(values), np.int64)
        for batch in batches:
            for part in batch_parts(batch):
                s = Shingles(part.column(0))
                place = np.minimum(np.searchsorted(values, s.hash), len(values) - 1)
                counts += np.bincount(place[values[place] == s.hash], minlength=len(values))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(values[seen].view(np.int64)), pa.array(counts[seen])], names=["shingle", "n"])

    return run


class Weights:
    """IDF by shingle: the frequent ones are listed, all others weigh 1."""

    def __init__(self, values: np.ndarray, counts: np.ndarray, texts: int):
        order = np.argsort(values)
        self.values = values[order]
        share = np.log(texts / np.maximum(counts[order], 1)) / math.log(COMMON)
        self.idf = FLOOR + (1 - FLOOR) * np.clip(share, 0, 1)

    def of(self, s: Shingles) -> np.ndarray:
        weight = s.tf.copy()
        if len(self.values):
            place = np.minimum(np.searchsorted(self.values, s.hash), len(self.values) - 1)
            known = self.values[place] == s.hash
            weight[known] *= self.idf[place[known]]
        return weight


def frequent_weights(worded: DataFrame, texts: int, characters: int) -> Weights:
    """Exact document frequencies of all shingles that at least one in ``COMMON`` texts has, from a column ``words``."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), max(texts, 1)
    if not texts:
        return Weights(*none)
    with dropping_shuffles(worded.sparkSession):
        return _frequent_weights(worded, texts, characters, none)


def _frequent_weights(worded: DataFrame, texts: int, characters: int, none: tuple) -> Weights:
    least = max(2, texts / COMMON)
    # tasks of thousands of texts can tell what is rare: all together they may keep a quarter of ``least`` to themselves
    gathered = worded.select("words").coalesce(max(1, math.ceil(texts / TASK_TEXTS)))
    room = math.ceil(characters / 2 / least) + 64  # for words of three letters on average; doubled if that is too few
    while True:
        parts = gathered.mapInArrow(_candidates(room, least / 4 / texts), "shingle long, n long")
        merged = parts.groupBy("shingle").agg(F.sum("n").alias("n")).where((F.col("n") >= least / 2) | F.col("shingle").isNull()).toArrow()
        shingle, n = merged.column("shingle"), merged.column("n")
        lost = pc.sum(n.filter(shingle.is_null())).as_py() or 0
        if lost <= least / 2:
            break
        room *= 2
    held = shingle.drop_null().to_numpy()
    if not len(held):
        return Weights(*none)
    wanted = worded.sparkSession.sparkContext.broadcast(np.sort(held.view(np.uint64)))
    counts = worded.select("words").mapInArrow(_counted(wanted), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= least).toArrow()
    return Weights(found.column("shingle").to_numpy().view(np.uint64), found.column("n").to_numpy(), texts)


def _randoms() -> tuple[np.ndarray, ...]:
    """r, ln c and beta of consistent weighted sampling, by sample and slot of the table."""
    rng = np.random.default_rng(20100101)
    n = (BANDS * ROWS, _TABLE)
    return rng.gamma(2, 1, n).astype(np.float32), np.log(rng.gamma(2, 1, n)).astype(np.float32), rng.random(n, np.float32)


def samples(s: Shingles, weight: np.ndarray, randoms) -> np.ndarray:
    """Samples of each text, 32 bits each."""
    r, ln_c, beta = randoms
    out = np.empty((len(s.first), BANDS * ROWS), np.uint32)
    ln_w = np.log(weight).astype(np.float32)
    size = np.diff(np.append(s.first, len(s.hash)))
    for k in range(BANDS * ROWS):
        mixed = (s.hash ^ np.uint64(k * 0x5851F42D4C957F2D & (1 << 64) - 1)) * _MIX
        slot = (mixed >> np.uint64(64 - 14)).view(np.int64)
        rk, bk, ln_a = r[k].take(slot), beta[k].take(slot), ln_c[k].take(slot)
        t = ln_w / rk
        t += bk
        np.floor(t, out=t)
        ln_a -= rk * (t - bk)
        ln_a -= rk
        # ties, as of shingles that share a slot, go to the smallest hash: the order within a text is by hash
        low = np.repeat(np.minimum.reduceat(ln_a, s.first), size)
        best = np.flatnonzero(ln_a == low)
        of = s.owner[best]
        best = best[np.flatnonzero(np.diff(of, prepend=-1))]
        chosen = (s.hash[best] ^ (t[best].astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * _MIX
        out[:, k] = (chosen >> np.uint64(32)).astype(np.uint32)
    return out


def _signed(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        randoms = _randoms()
        for batch in batches:
            for part in batch_parts(batch, 1 << 20):
                s = Shingles(part.column(3))
                got = samples(s, weights.value.of(s), randoms)
                size = pc.list_value_length(part.column(3)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([x.tobytes() for x in got], pa.binary()), size], names=["id", "h1", "h2", "samples", "size"])

    return run


def band_keys(got: np.ndarray) -> np.ndarray:
    """Keys of the buckets of texts, by band, from their samples."""
    got = got.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX, got.shape[:2]).copy()
    for k in range(ROWS):
        key = (key ^ got[:, :, k]) * _MIX
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text and band: the key of its bucket."""
    for batch in batches:
        key = band_keys(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32))
        ids = np.repeat(batch.column(0).to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(key.reshape(-1))], names=["id", "key"])


def alike(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
    """Whether two texts, by hashes and weights of their shingles, are similar: by weights, or by mere numbers of shingles."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    weighted = shared / (a[1].sum() + b[1].sum() - shared)
    return max(weighted, len(i) / (len(a[0]) + len(b[0]) - len(i))) >= SIMILAR


def _weighed(words: pa.ListArray, weights) -> list[tuple[np.ndarray, np.ndarray]]:
    s = Shingles(words)
    weight, edge = weights.value.of(s), np.append(s.first, len(s.hash))
    return [(s.hash[x:y], weight[x:y]) for x, y in zip(edge[:-1], edge[1:])]


def _verified(weights):
    """Links a, b of each star: rows (a, part, b, words) sorted so that the centre, which has no b, comes first of its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, centre = None, None
        for batch in batches:
            for rows in batch_parts(batch):
                links = []
                for a, part, b, text in zip(*(rows.column(k).to_pylist() for k in range(3)), _weighed(rows.column(3), weights)):
                    if b is None:
                        star, centre = (a, part), text
                    elif star == (a, part) and alike(centre, text):
                        links.append((a, b))
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

    return run


def _same_samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs a, b that agree in enough samples."""
    for batch in batches:
        left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for k in (2, 3))
        yield batch.select([0, 1]).filter(pa.array((left == right).sum(axis=1) >= AGREEING))


def _texts_of(docs: DataFrame, ids: DataFrame, repeated: bool) -> DataFrame:
    """id, text of the documents with these identifiers; of an identifier that repeats, the least text."""
    found = maybe_among(docs.select("id", "text"), ids, "id").join(ids, "id", "left_semi")
    return found.groupBy("id").agg(F.min("text").alias("text")) if repeated else found


def verified(stars: DataFrame, signed: DataFrame, docs: DataFrame, weights, scratch: Scratch, repeated: bool) -> DataFrame:
    """The pairs (a, b) of a star's centre and another text that are similar, as a table on shared storage.

    Samples decide first; then each text goes to its stars once, and centres of large stars to each part of them.
    """
    samples_of = lambda c: signed.select(F.col("id").alias(c), F.col("samples").alias(f"samples_{c}"))
    sampled = stars.join(samples_of("a"), "a").join(samples_of("b"), "b").select("a", "b", "samples_a", "samples_b")
    pairs = scratch.write("pairs", sampled.mapInArrow(_same_samples, "a long, b long"))
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
    others = pairs.join(sizes, "a").select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), "b")
    centres = sizes.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"))
    members = scratch.write("members", others.unionByName(centres))
    texts = _texts_of(docs, members.select("id").distinct(), repeated)
    placed = members.join(texts, "id").select("a", "part", "b", "text").repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    links = scratch.write("links", placed.select("a", "part", "b", _hashed("text").alias("words")).mapInArrow(_verified(weights), "a long, b long"))
    scratch.drop("pairs", "members")
    return links


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of each key; they come sorted by it."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns))):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _agreeing(rows: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of two rows (pair, key, side, id, label, samples) of different classes and, of two blocks, different sides
    that agree in enough samples, and in how many; only in the first of the bands that both share."""
    side, label = np.array([r[2] for r in rows]), np.array([r[4] for r in rows], np.int64)
    got = np.frombuffer(b"".join(r[5] for r in rows), np.uint32).reshape(len(rows), -1)
    keys = band_keys(got)
    for at in range(0, len(rows), 64):
        block = got[at : at + 64]
        for other in range(at, len(rows), 2048):
            far = got[other : other + 2048]
            agree = np.zeros((len(block), len(far)), np.int16)
            for k in range(got.shape[1]):
                agree += block[:, k][:, None] == far[:, k][None, :]
            left, right = side[at : at + 64][:, None], side[other : other + 2048][None, :]
            apart = (label[at : at + 64][:, None] != label[other : other + 2048][None, :]) & ((left != right) | (left == BOTH))
            x, y = np.nonzero((agree >= AGREEING) & apart)
            many = agree[x, y]
            x, y = x + at, y + other
            for part in range(0, len(x), 1 << 16):
                a, b, n = (v[part : part + (1 << 16)] for v in (x, y, many))
                first = keys[a, (keys[a] == keys[b]).argmax(axis=1)]
                here = (a < b) & (first == rows[0][1])
                yield a[here], b[here], n[here]


def _with_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (pair, key, side, id, label, samples) that have a partner to be compared with in their group."""
    kinds = {"pair": pa.int64(), "key": pa.int64(), "side": pa.int32(), "id": pa.int64(), "label": pa.int64(), "samples": pa.binary()}
    for rows in _by_key(batches):
        found = np.zeros(len(rows), bool)
        for x, y, _ in _agreeing(rows):
            found[x] = found[y] = True
        if found.any():
            kept = [rows[k] for k in np.flatnonzero(found)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), kinds.values())], names=list(kinds))


def _joining(weights):
    """Links that join classes within a group: rows (pair, key, side, id, label, samples, hashed words). Partners are
    compared by their shingles as they are found, unless links found before have joined their classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches):
            texts = _weighed(pa.array([r[6] for r in rows], pa.list_(pa.int64())), weights)
            root = {r[4]: r[4] for r in rows}

            def find(label: int) -> int:
                while root[label] != label:
                    root[label] = label = root[root[label]]
                return label

            links = []
            for x, y, n in _agreeing(rows):
                for k in np.argsort(-n, kind="stable").tolist():
                    a, b = int(x[k]), int(y[k])
                    p, q = find(rows[a][4]), find(rows[b][4])
                    if p != q and alike(texts[a], texts[b]):
                        root[max(p, q)] = min(p, q)
                        links.append(sorted((rows[a][3], rows[b][3])))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

    return run


def _block_pairs(rows: DataFrame) -> DataFrame:
    """pair, key, side, id, label, samples: rows (key, id, label, samples) of buckets with several classes, in each pair of
    blocks that they belong to.

    Classes of a block and more have blocks of their own, which need not meet each other; the others share theirs. A row is written
    once for each block that its bucket has, so a bucket of up to ``BLOCK`` texts has each of them once.
    """
    words = F.sum("size") if "size" in rows.columns else F.lit(0)
    blocks_of = F.greatest(F.count("*") / BLOCK, words / BLOCK_WORDS)
    classes = rows.groupBy("key", "label").agg(blocks_of.alias("n"))
    shared = F.sum(F.when(F.col("n") < 1, F.col("n")))
    sizes = classes.groupBy("key").agg(F.count("*").alias("classes"), shared.alias("shared")).where("classes > 1").select("key", "shared")
    own = F.when(F.col("n") >= 1, F.col("label"))
    classes = classes.join(sizes, "key").select("key", "label", own.alias("own"), F.ceil(F.when(F.col("n") >= 1, F.col("n")).otherwise(F.col("shared"))).alias("parts"))
    block = F.when(F.col("own").isNull(), F.xxhash64(F.lit(-1), F.pmod(F.xxhash64("label"), "parts"))).otherwise(F.xxhash64("own", F.pmod(F.xxhash64("id"), "parts")))
    placed = rows.join(classes, ["key", "label"]).withColumn("block", block).drop("parts")
    blocks = placed.select("key", "own", "block").distinct()
    end = lambda c: blocks.select("key", F.col("own").alias(f"own_{c}"), F.col("block").alias(c))
    pairs = end("x").join(end("y"), "key").where("x <= y AND (own_x IS NULL OR own_y IS NULL OR own_x <> own_y)")
    of = lambda c, side: F.struct(F.col(c).alias("block"), F.lit(side).alias("side"))
    ends = F.when(F.col("x") == F.col("y"), F.array(of("x", BOTH))).otherwise(F.array(of("x", 0), of("y", 1)))
    ends = pairs.select("key", F.xxhash64("key", "x", "y").alias("pair"), F.explode(ends).alias("end")).select("key", "pair", "end.*")
    return placed.join(ends, ["key", "block"]).select("pair", "key", "side", "id", "label", "samples")


def _identified(docs: DataFrame, doc_id: str, text: str) -> Column:
    """The identifier, or for a null one a number beyond all identifiers that the text gives."""
    beyond = F.lit(_NO_ID) + F.xxhash64(whole(text)).bitwiseAND(F.lit(_NO_ID - 1))
    return F.coalesce(docs[doc_id].cast("long"), beyond)


def _classes(docs: DataFrame) -> DataFrame:
    """id, label, n_links of every row of docs (id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    worded = docs.select("id", _hashed("text").alias("words"))
    size = docs.agg(F.count("*").alias("texts"), F.sum(F.char_length("text")).alias("characters")).first()
    weights = spark.sparkContext.broadcast(frequent_weights(worded, size.texts, size.characters or 0))
    # two hashes of all words: texts that agree in both are taken as equal
    keyed = worded.select("id", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), F.reverse("words")).alias("h2"), "words")
    copies = scratch.write("signed", keyed.mapInArrow(_signed(weights), "id long, h1 long, h2 long, samples binary, size long"))
    firsts = scratch.write("firsts", copies.groupBy("h1", "h2").agg(F.min("id").alias("id")))
    repeated = not copies.groupBy("id").count().where("count > 1").isEmpty()
    signed = copies.join(firsts, ["h1", "h2", "id"], "left_semi").select("id", "samples", "size")
    signed = scratch.write("distinct", signed.dropDuplicates(["id"]) if repeated else signed)
    bands = signed.select("id", "samples").mapInArrow(_banded, "id long, key long")
    buckets = bands.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
    bands = scratch.write("bands", bands.join(buckets, "key").select("id", "key", "a"))
    stars = bands.select("a", F.col("id").alias("b")).where("a <> b").distinct()
    links = verified(stars, signed, docs, weights, scratch, repeated)
    nodes = bands.select("id").distinct()
    labels = components(nodes, links, scratch, "first")
    held = bands.join(labels, "id").select("key", "id", "label").join(signed, "id").select("key", "id", "label", "samples", "size")
    parts = _block_pairs(scratch.write("held", held))
    sorted_ = parts.repartition("pair").sortWithinPartitions("pair")
    partners = scratch.write("partners", sorted_.mapInArrow(_with_partners, "pair long, key long, side int, id long, label long, samples binary"))
    texts = _texts_of(docs, partners.select("id").distinct(), repeated)
    spelled = partners.join(texts, "id").select(*partners.columns, "text").repartition("pair").sortWithinPartitions("pair")
    spelled = spelled.select(*partners.columns, _hashed("text").alias("words"))
    late = scratch.write("late", spelled.mapInArrow(_joining(weights), "a long, b long").distinct())
    scratch.drop("held", "bands", "partners", "distinct")
    labels = components(nodes, late, scratch, "all", labels)
    ends = links.unionByName(late).select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    by_text = firsts.join(labels, "id", "left").join(ends, "id", "left")
    by_text = by_text.select("h1", "h2", F.coalesce("label", "id").alias("label"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return copies.select("id", "h1", "h2").join(by_text, ["h1", "h2"]).select("id", "label", "n_links")


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id (smallest identifier of the class), class_size, n_links, kept of every row.

    ``n_links`` counts the links of the document's text that made its class, and ``kept`` marks one document of each class.
    """
    classed = _classes(docs.select(_identified(docs, doc_id, text).alias("id"), whole(text).alias("text")))
    scratch = Scratch(docs.sparkSession, "near-classes")
    classed = scratch.write("classed", classed)
    sizes = classed.groupBy("label").agg(F.count("*").alias("n"))
    least = max(LARGE_CLASS, classed.count() // 1_000_000)
    large = sizes.where(F.col("n") >= least).select("label", F.col("n").alias("n_large"))
    small = sizes.where(F.col("n") < least).select(F.col("label").alias("small"), "n")
    # rows of large classes, that have their size, are spread over the second join
    told = classed.join(F.broadcast(large), "label", "left").withColumn("small", F.when(F.col("n_large").isNull(), F.col("label")).otherwise(F.xxhash64("id")))
    known = lambda c: F.when(F.col(c) < _NO_ID, F.col(c))
    return told.join(small, "small", "left").select(
        known("id").alias("doc_id"), known("label").alias("class_id"), F.coalesce("n_large", "n").alias("class_size"), "n_links", (F.col("id") == F.col("label")).alias("kept")
    )


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose identifier stands for their class."""
    name = unused("id", docs.columns)
    keyed = docs.withColumn(name, _identified(docs, doc_id, text))
    classed = _classes(keyed.select(F.col(name).alias("id"), whole(text).alias("text")))
    lost = classed.where("id <> label").select(F.col("id").alias(name)).distinct()
    return keyed.join(lost, name, "left_anti").select(*docs.columns)
