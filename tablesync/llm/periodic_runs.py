"""Runs of periodic words: stretches that repeat with a smallest period, found in tiles and stitched.

The words of a text are looked at once for each octave of periods. An octave of periods ``low..high`` has boundaries ``step`` words
apart, so close that the words of any run that equal those a period further on span a whole step. Neighbouring
boundaries make a tile; tiles overlap by what a period and two steps need. For each octave:

1. A hash of each step tells which tiles can hold a run; equal words have equal hashes, so none is lost. The words of these
   tiles, numbered by value, become rows of a scratch table; most texts have none and are done.
2. Tiles are dealt over all tasks, those of one text too, and solved on their own: the Z-function from a boundary on says
   how far the words equal those a period later, the Z-function of the reversed words how far back, and the first one
   also whether a shorter period does the same. Hashes decide nothing here.
3. Fragments meet by document and period and are stitched where they touch or overlap. Runs are what is long enough.

A word is dropped by `collapsed` if some run holds it after that run's first period. A document in ten is made periodic first, as
the contract says: see `altered`.

Null texts count as empty; a document without identifier is never altered. Rows are told apart by identifier and text, so repeated
rows get equal results. Runs of one start are ordered by period; there is one of each start and period. An empty table gives an empty
result. Columns beside identifier and text are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import Scratch, batch_parts

LEAST = 12
#: Boundaries of a tile.
BOUNDARIES = 8
BLOCK = 1 << 21
BASE = 0x9E3779B97F4A7C15


def octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """low, high, step of the periods that runs of n words may have."""
    if n >= LEAST:
        yield 1, 7, 3
    low = 8
    while 2 * low <= n:
        yield low, 2 * low - 1, low // 2
        low *= 2


def altered(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of a document; of one document in ten, all from a drawn place on repeat those that come first."""
    h, n = 1 if doc_id is None else zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


class _Hashes:
    """Hashes of stretches of words, by powers that all texts share."""

    def __init__(self):
        self.power = self.inverse = np.ones(1, np.uint64)

    def prefixes(self, ids: np.ndarray) -> np.ndarray:
        if len(self.power) < len(ids):
            size = 2 * len(ids)
            for name, base in (("power", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        value = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        out = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(value * self.power[: len(ids)], out=out[1:])
        return out

    def steps(self, prefixes: np.ndarray, step: int) -> np.ndarray:
        return (prefixes[step:] - prefixes[:-step]) * self.inverse[: len(prefixes) - step]


def numbered(words: list[bytes]) -> np.ndarray:
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    return np.fromiter(map(number.__getitem__, words), np.int32, len(words))


def tiles(ids: np.ndarray, hashes: _Hashes) -> Iterator[tuple[int, int, int, int, int, np.ndarray]]:
    """low, step, first boundary, place of the first word, boundaries to solve (as bits), and words of tiles that may hold runs."""
    n = len(ids)
    prefixes = hashes.prefixes(ids) if n >= LEAST else None
    for low, high, step in octaves(n):
        found = hashes.steps(prefixes, step)
        count = max(0, (n - step - low) // step + 1)
        width = high - low + 1
        found = np.concatenate((found, np.zeros(high + step, np.uint64)))
        windows = sliding_window_view(found, width)[low::step]
        hit = np.empty(count, bool)
        rows = max(1, BLOCK // width)
        for at in range(0, count, rows):
            stop = min(count, at + rows)
            hit[at:stop] = (windows[at:stop] == found[at * step : (stop - 1) * step + 1 : step, None]).any(axis=1)
        if not hit.any():
            continue
        hit = np.concatenate((hit, np.zeros(-count % BOUNDARIES, bool))).reshape(-1, BOUNDARIES)
        for k in np.flatnonzero(hit.any(axis=1)).tolist():
            first = k * BOUNDARIES * step
            left, right = max(0, first - step), min(n, first + (BOUNDARIES + 1) * step + high)
            bits = int((hit[k] << np.arange(BOUNDARIES)).sum())
            yield low, step, first, left, bits, np.unique(ids[left:right], return_inverse=True)[1].astype("<u4")


def z_function(x: list[int], upto: int) -> list[int]:
    """For each of the first ``upto`` places, how many words from there on equal the first words."""
    n, left, right = len(x), 0, 0
    z = [0] * upto
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and x[k] == x[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def primes_of(q: int) -> list[int]:
    found, d = [], 2
    while d * d <= q:
        if q % d == 0:
            found.append(d)
            while q % d == 0:
                q //= d
        d += 1
    return found + [q] * (q > 1)


def fragments(low: int, step: int, first: int, left: int, bits: int, ids: list[int]) -> list[tuple[int, int, int]]:
    """period, start, stop: places whose words equal those a period later, around the boundaries of a tile.

    Only periods that no shorter one explains; a fragment may go on in the next tile.
    """
    high = 7 if low == 1 else 2 * low - 1
    open_: dict[int, list[int]] = {}
    out = []
    for k in range(BOUNDARIES):
        if not bits >> k & 1:
            continue
        at = first + k * step - left
        ahead = ids[at : at + 2 * step + high]
        z = z_function(ahead, min(high + 1, len(ahead)))
        periods = [q for q in range(low, len(z)) if z[q] >= step and all(z[q // r] < q - q // r for r in primes_of(q))]
        if not periods:
            continue
        before = ids[max(0, at - step) : at]
        reach = min(high, len(ahead))
        back = z_function(before[::-1] + [-1] + ids[max(0, at - step) : at + reach][::-1], len(before) + 1 + reach)
        for q in periods:
            start, stop = left + at - back[len(before) + 1 + reach - q], left + at + z[q]
            held = open_.get(q)
            if held and start <= held[1]:
                held[1] = max(held[1], stop)
                continue
            if held:
                out.append((q, *held))
            open_[q] = [start, stop]
    return out + [(q, *held) for q, held in open_.items()]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run (start, length, period) holds after its first period."""
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [w for w, gone in zip(words, np.cumsum(edges).tolist()) if not gone]


#: Rows of the scratch table: documents that are done, documents that wait for their runs, and tiles.
DONE, WAITING, TILE = 0, 1, 2
_SCANNED = (
    "kind int, key binary, doc_id long, collapsed_sha256 string, words binary, low int, step int, first long, start long, bits int, ids binary"
)
_NAMES = [c.split()[0] for c in _SCANNED.split(", ")]
_KINDS = [pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), _KINDS)], names=_NAMES)

    for batch in batches:
        for some in batch_parts(batch):
            rows, size = [], 0
            for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                words = altered(doc_id, (text or b"").split())
                whole = b" ".join(words)
                key = None
                for low, step, first, left, bits, ids in tiles(numbered(words), hashes):
                    key = key or hashlib.md5(f"{doc_id}:".encode() + whole).digest()
                    rows.append((TILE, key, None, None, None, low, step, first, left, bits, ids.tobytes()))
                    size += 4 * len(ids)
                    if size > 8 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if key:
                    rows.append((WAITING, key, doc_id, None, whole, *[None] * 6))
                    size += len(whole)
                else:
                    rows.append((DONE, None, doc_id, hashlib.sha256(whole).hexdigest(), *[None] * 7))
            if rows:
                yield batch_of(rows)


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "period", "low", "high"]
    for batch in batches:
        keys, found = [], []
        for key, low, step, first, start, bits, ids in zip(*(batch.column(k).to_pylist() for k in range(7))):
            some = fragments(low, step, first, start, bits, np.frombuffer(ids, "<u4").tolist())
            keys += [key] * len(some)
            found += some
        columns = zip(*found) if found else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(pa.array(c, pa.int64()) for c in columns)], names=names)


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_runs", "start", "length", "period", "runs_sha256", "collapsed_sha256"]
    for batch in batches:
        for some in batch_parts(batch):
            shas = []
            for whole, runs in zip(some.column(1).to_pylist(), some.column(2).to_pylist()):
                kept = collapsed(whole.split(), [(r["start"], r["length"], r["period"]) for r in runs or ()])
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            columns = [some.column(0), *(some.column(k) for k in range(3, 8)), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def stitched(parts: DataFrame) -> DataFrame:
    """key, start, length, period of the runs that fragments (key, period, low, high) make."""
    ordered = Window.partitionBy("key", "period").orderBy("low", "high")
    reached = F.max("high").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = parts.withColumn("begins", F.coalesce(F.col("low") > reached, F.lit(True)).cast("int"))
    groups = begins.withColumn("run", F.sum("begins").over(ordered)).groupBy("key", "period", "run")
    found = groups.agg(F.min("low").alias("start"), F.max("high").alias("high"))
    length = F.col("high") - F.col("start") + F.col("period")
    return found.select("key", "start", length.alias("length"), "period").where(
        F.col("length") >= F.greatest(F.lit(LEAST), 2 * F.col("period"))
    )


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_runs, the longest run's start, length, period and exponent_milli, runs_sha256, collapsed_sha256."""
    scratch = Scratch(docs.sparkSession, "periodic-runs")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    scanned = scratch.write("scanned", texts.mapInArrow(_scanned, _SCANNED))
    spread = scanned.where(f"kind = {TILE}").repartition("key", "low", "first")
    parts = spread.select("key", "low", "step", "first", "start", "bits", "ids").mapInArrow(_fragments, "key binary, period long, low long, high long")
    run = F.struct("start", "period", "length")
    longest = F.max(F.struct("length", (-F.col("start")).alias("start"), (-F.col("period")).alias("period")))
    by_key = stitched(parts).groupBy("key").agg(F.array_sort(F.collect_list(run)).alias("runs"), longest.alias("most"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    told = by_key.select(
        "key",
        "runs",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("most.start")).alias("start"),
        F.col("most.length").alias("length"),
        (-F.col("most.period")).alias("period"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.lit("\n")), 256).alias("runs_sha256"),
    )
    none = F.sha2(F.lit(""), 256)
    waiting = scanned.where(f"kind = {WAITING}").select("key", "doc_id", "words").join(told, "key", "left").select(
        "doc_id", "words", "runs", F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"), "start", "length", "period", F.coalesce("runs_sha256", none).alias("runs_sha256")
    )
    schema = "doc_id long, n_runs long, start long, length long, period long, runs_sha256 string, collapsed_sha256 string"
    nothing = F.lit(None).cast("long")
    done = scanned.where(f"kind = {DONE}").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), *(nothing.alias(c) for c in ("start", "length", "period")), none.alias("runs_sha256"), "collapsed_sha256"
    )
    every = waiting.mapInArrow(_collapsed, schema).unionByName(done)
    return every.select(
        "doc_id", "n_runs", "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )
