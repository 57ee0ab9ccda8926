"""Packing examples into training sequences as vector bin packing.

A sequence has three limits at once: tokens, segments, and loss-bearing tokens (those after an example's prompt). An
example is a vector of its demands. The open sequence takes, among the waiting examples that fit, the one whose demand
has the largest dot product with what the sequence has left, each dimension in units of its limit and weighed by its
mean demand: so a sequence short of segments takes long examples, one short of loss takes prompts. When nothing fits
whole, an example is cut to fill the rest, unless less than ``least`` tokens are left.

Sequences are padded to the token limit, or not at all if their length is a power of two. A sequence that other limits or
the end of the data leave with more padding than ``least`` gives its last tokens back and ends at a power of two.

Each task packs the rows it reads: nothing is shuffled. Examples wait in a pool of bounded size, which is packed while it
is full and to its end when the task ends, so memory does not grow with the task and any number of rows will do.
Sequence ids are unique: the task's partition in the high bits.

Null texts count as empty and are one end id. Identifiers may be null or repeat; pieces say which document they are of,
and ``start`` counts from its first id. An empty table gives no pieces. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import whole
from tablesync.llm.tokens import encoder


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 256
    loss: int = 4096
    #: Fewest tokens that are worth a cut, and most that are left as padding.
    least: int = 16


@dataclass
class Example:
    """Tokens from ``start`` of a document; those before ``prompt`` bear no loss."""

    key: object
    start: int
    length: int
    prompt: int = 0

    @property
    def loss(self) -> int:
        return self.length - min(max(self.prompt - self.start, 0), self.length)

    def cut(self, n: int) -> tuple[Example, Example]:
        return Example(self.key, self.start, n, self.prompt), Example(self.key, self.start + n, self.length - n, self.prompt)

    def fitting(self, tokens: int, loss: int) -> int:
        """Most tokens from its front within both limits."""
        free = min(max(self.prompt - self.start, 0), self.length)
        return min(self.length, tokens, free + loss)


class Packer:
    """Waiting examples and the sequences they become."""

    def __init__(self, limits: Limits = Limits()):
        self.limits = limits
        self.limit = np.array([limits.tokens, 1, limits.loss], np.float64)
        self.unit = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
        self.items: list[Example] = []
        self.need = np.zeros((0, 3))
        self.live = 0
        self.tokens = 0

    def add(self, examples: list[Example]) -> None:
        """Examples join the pool; empty ones need no place."""
        new = [p for e in examples for p in self._pieces(e)]
        if new:
            kept = np.flatnonzero(self.need[:, 1] > 0)
            self.items = [self.items[k] for k in kept] + new
            self.need = np.concatenate((self.need[kept], [self._demand(p) for p in new]))
            self.live = len(self.items)
            self.tokens = int(self.need[:, 0].sum())

    def _demand(self, e: Example) -> tuple[int, int, int]:
        return e.length, 1, e.loss

    def _pieces(self, e: Example) -> Iterator[Example]:
        while e.length:
            n = e.fitting(self.limits.tokens, self.limits.loss)
            front, e = e.cut(n)
            yield front

    def sequences(self, waiting: int = 0) -> Iterator[list[Example]]:
        """Sequences, while more than ``waiting`` tokens wait."""
        while self.live and self.tokens > waiting:
            yield self._sequence()

    def _sequence(self) -> list[Example]:
        left, taken = self.unit.copy(), []
        weight = self.need.sum(axis=0) / self.live / self.unit / self.unit
        while left[1] >= 1 and left[0] >= 1 and self.live:
            fits = (self.need[:, 0] <= left[0]) & (self.need[:, 2] <= left[2]) & (self.need[:, 1] > 0)
            score = np.where(fits, self.need @ (weight * left), -1.0)
            k = int(score.argmax())
            if score[k] < 0:
                break
            left -= self.need[k]
            taken.append(self._take(k))
        if left[0] >= self.limits.least and left[1] >= 1 and self.live:
            score = np.where(self.need[:, 1] > 0, self.need @ (weight * left), -1.0)
            k = int(score.argmax())
            n = self.items[k].fitting(int(left[0]), int(left[2]))
            if n >= self.limits.least:
                front, rest = self._take(k).cut(n)
                taken.append(front)
                self._put(k, rest)
                left[0] -= n
        if left[0] > 0 and (left[0] >= self.limits.least or not self.live):
            self._round_down(taken, int(self.limits.tokens - left[0]))
        return taken

    def _round_down(self, taken: list[Example], length: int) -> None:
        """Give back what lies beyond the largest power of two."""
        extra = length - (1 << (length.bit_length() - 1))
        back = []
        while extra:
            last = taken.pop()
            if last.length > extra:
                front, last = last.cut(last.length - extra)
                taken.append(front)
            extra -= last.length
            back.append(last)
        self.add(back)

    def _take(self, k: int) -> Example:
        self.tokens -= int(self.need[k, 0])
        self.live -= 1
        self.need[k] = 0
        return self.items[k]

    def _put(self, k: int, e: Example) -> None:
        self.items[k], self.need[k] = e, self._demand(e)
        self.tokens += e.length
        self.live += 1


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long, ids binary"


def _packed(path: str, end: int, limits: Limits, pool: int, with_ids: bool):
    names = [f.split()[0] for f in _PIECES.split(", ")]
    kinds = [pa.binary() if n == "ids" else pa.int64() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = encoder(path, end), Packer(limits)
        next_id = TaskContext.get().partitionId() << 32
        docs: dict[int, tuple] = {}  # by row: document, its ids, tokens that are not placed yet
        row = 0

        def placed(waiting: int) -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            out: list[tuple] = []
            for sequence in packer.sequences(waiting):
                at = 0
                for e in sequence:
                    doc_id, ids, open_ = docs[e.key]
                    piece = ids[e.start : e.start + e.length].astype("<u4").tobytes()
                    out.append((doc_id, e.start, e.length, zlib.crc32(piece), len(ids), next_id, at, e.loss, piece if with_ids else None))
                    at += e.length
                    docs[e.key] = (doc_id, ids, open_ - e.length)
                    if open_ == e.length:
                        del docs[e.key]
                next_id += 1
                if len(out) >= 4096:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                new = []
                for doc_id, prompt, ids in zip(some.column(0).to_pylist(), some.column(2).to_pylist(), coder.encode(some.column(1).to_pylist())):
                    docs[row] = (doc_id, ids, len(ids))
                    new.append(Example(row, 0, len(ids), prompt))
                    row += 1
                packer.add(new)
                if packer.tokens > 2 * pool:
                    yield from placed(pool)
        yield from placed(0)

    return run


def pack(docs: DataFrame, tokenizer: str, end: int, limits: Limits = Limits(), doc_id: str = "doc_id", text: str = "text", prompt: str | None = None, pool: int = 1 << 18, with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document in a sequence.

    ``prompt`` names a column with the number of first tokens that bear no loss. ``with_ids`` adds the ids themselves,
    little-endian unsigned 32-bit.
    """
    before = F.coalesce(F.col(prompt).cast("long"), F.lit(0)) if prompt else F.lit(0).cast("long")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.encode(whole(text), "UTF-8").alias("text"), before.alias("prompt"))
    pieces = rows.mapInArrow(_packed(tokenizer, end, limits, pool, with_ids), _PIECES)
    return pieces if with_ids else pieces.drop("ids")
