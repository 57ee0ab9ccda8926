"""Repair of conversation structure: damage, faults, and the cheapest edits that give a lawful order of roles.

A conversation is lawful if the initials of its roles read ``(s?(ua)+)?``. Edits in order are Keep (0), Rerole to user or
assistant (1), Delete (2; blank and repeated rows must go) and Insert of an empty user or assistant row (5); a truncated row that
is not deleted costs 5 more. Of the cheapest edits those whose initials come first in ASCII order are taken.

States are ``0`` nothing yet, ``1`` after the system row, ``2`` after a user row, ``3`` after an assistant row. For each state the
dynamic programme holds its cost and a `Trail` node: edits so far as a linked list that shares its beginnings. A node knows its
ancestors at distances of powers of two and a rolling hash of its whole string; two trails of equal cost are compared
by searching their longest common prefix through these. Where hashes agree for two different nodes, their letters are compared,
so a collision costs time and never changes a result.

Rows are dealt by ranges of conversation and turn, so that a conversation of any length is spread. One that lies within a task, of
up to ``SEGMENT`` rows, is solved there. Others become segments: rows of a scratch table. Copies of a row in earlier segments
are found by digest; each segment is solved from every state, and the segments of a conversation are chained by the same
programme with a segment's edits as one step. What one task sees of a long conversation is 16 strings of edits for
each segment, then its repaired text as a stream: the contract wants one string and one hash of it all.

Null roles, texts and parts of the damage key count as one space; rows without an identifier are one conversation. Rows
of one turn, null turns first, are ordered by role, then by a hash of role and text. An empty table gives an
empty result. Columns beside the four are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import Scratch

SEGMENT = 2048
SEGMENT_BYTES = 4 << 20
SPACE = " \t\n\x0b\x0c\r"
BASE, PRIME = 0x1F3D5B79A8642135, (1 << 61) - 1
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: State that a row of an initial leads to, by state before.
NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


class Trail:
    """A string that grows by pieces and shares its beginning with others."""

    __slots__ = ("up", "depth", "piece", "hash", "mark")

    def __init__(self, parent: Trail | None = None, piece: str = "", mark: int = 0):
        self.piece, self.mark = piece, mark
        if parent is None:
            self.up, self.depth, self.hash = (), 0, 0
            return
        up, k = [parent], 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        self.up, self.depth = up, parent.depth + 1
        value = parent.hash
        for letter in piece:
            value = (value * BASE + ord(letter)) % PRIME
        self.hash = value

    def above(self, steps: int) -> Trail:
        node, k = self, 0
        while steps:
            if steps & 1:
                node = node.up[k]
            steps, k = steps >> 1, k + 1
        return node

    def nodes(self, since: int = 0) -> list[Trail]:
        found, node = [], self
        while node.depth > since:
            found.append(node)
            node = node.up[0]
        return found[::-1]

    def text(self, since: int = 0) -> str:
        return "".join(node.piece for node in self.nodes(since))


def _same(a: Trail, b: Trail) -> bool:
    """Whether two trails of equal hash and depth are one string: pieces are compared down to a shared node."""
    while a is not b:
        if a.piece != b.piece:
            return False
        a, b = a.up[0], b.up[0]
    return True


def comes_before(a: Trail, b: Trail) -> bool:
    """Whether the string of ``a`` is less than that of ``b``."""
    level = min(a.depth, b.depth)
    x, y = a.above(a.depth - level), b.above(b.depth - level)
    if x.hash == y.hash and _same(x, y):
        return a.text(level) < b.text(level)
    for k in range(len(x.up) - 1, -1, -1):
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    if not _same(x.up[0], y.up[0]):
        return a.text() < b.text()
    if len(x.piece) == len(y.piece) and x.piece != y.piece:
        return x.piece < y.piece
    return a.text(x.depth - 1) < b.text(x.depth - 1)


States = dict[int, tuple[int, Trail]]


def _offer(states: States, state: int, cost: int, parent: Trail, piece: str, mark: int = 0) -> None:
    held = states.get(state)
    if held and held[0] < cost:
        return
    node = Trail(parent, piece, mark)
    if not held or cost < held[0] or comes_before(node, held[1]):
        states[state] = (cost, node)


def _inserted(states: States) -> States:
    """States with any rows inserted here: a user row, an assistant row, or both."""
    for source, target in ((0, 2), (1, 2), (3, 2), (2, 3)):
        if source in states:
            _offer(states, target, states[source][0] + INSERT, states[source][1], "I")
    return states


def edited(rows: Iterable[tuple[str, bool, bool]], start: int = 0, opening: bool = True) -> States:
    """Cheapest edits to each state; a row is its role's initial, whether it must go, and whether it is truncated.

    Rows are inserted before the first row only if it opens the conversation; the segment before has done so otherwise.
    """
    states: States = {start: (0, Trail())}
    if opening:
        _inserted(states)
    for initial, must_go, truncated in rows:
        after: States = {}
        for state, (cost, trail) in states.items():
            _offer(after, state, cost + DELETE, trail, "D")
            if must_go:
                continue
            kept = cost + (TRUNCATED if truncated else 0)
            if (initial, state) in NEXT:
                _offer(after, NEXT[initial, state], kept + KEEP, trail, "K")
            wanted = "a" if state == 2 else "u"
            if initial != wanted:
                _offer(after, NEXT[wanted, state], kept + REROLE, trail, "R")
        states = _inserted(after)
    return states


def best(states: States) -> tuple[int, Trail]:
    """The cheaper lawful end; of equal ones the string that comes first."""
    ends = [states[s] for s in (0, 3) if s in states]
    if len(ends) == 2 and (ends[1][0] < ends[0][0] or ends[1][0] == ends[0][0] and comes_before(ends[1][1], ends[0][1])):
        return ends[1]
    return ends[0]


def repaired(rows: list[tuple], audit: str, state: int = 0) -> list[str]:
    """``role:text`` of what the edits leave of rows (turn, role, text)."""
    lines, at = [], 0
    for edit in audit:
        role, text = rows[at][1:3] if edit != "I" else ("", "")
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role, text = ("assistant" if state == 2 else "user"), "" if edit == "I" else text
        state = NEXT[role[:1], state]
        lines.append(f"{role}:{text}")
    return lines


def faults(rows: list[tuple], earlier: Iterable[bytes] = ()) -> tuple[list[tuple[str, bool, bool]], list[int]]:
    """Rows as `edited` takes them, and the counts of blank, duplicate and truncated ones."""
    found, counts, seen, earlier = [], [0, 0, 0], set(), set(earlier)
    for row in rows:
        role, text = row[1], row[2]
        stripped = text.rstrip(SPACE)
        again = (role, text) in seen or bool(earlier) and digest(role, text) in earlier
        fault = 0 if not stripped else 1 if again else 2 if stripped[-1] not in ".!?" else 3
        if fault < 3:
            counts[fault] += 1
        seen.add((role, text))
        found.append((role[:1], fault < 2, fault == 2))
    return found, counts


def digest(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage; a dropped row stays, with ``there`` false and no text."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    hit = F.pmod(F.crc32(F.encode(key, "UTF-8")), F.lit(20))
    role, text = F.coalesce(F.col("role").cast("string"), blank), F.coalesce(F.col("text").cast("string"), blank)
    told = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), hit.alias("hit"), role.alias("role"), text.alias("text"))
    return told.select(
        "conv_id",
        "turn",
        (F.col("hit") != 0).alias("there"),
        F.when(F.col("hit") == 0, "").when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") < 2, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
NAMES = [c.split()[0] for c in RESULT.split(", ")]
_ROWS = "array<struct<turn: bigint, role: string, text: string>>"


def _solution(rows: list[tuple]) -> tuple:
    told, (blank, duplicate, truncated) = faults(rows)
    cost, trail = best(edited(told))
    audit = trail.text()
    turns = sorted({row[0] for row in rows if row[0] is not None})
    gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
    text = "\n".join(repaired(rows, audit))
    return gaps, blank, duplicate, truncated, illegal_pairs([t[0] for t in told]), cost, audit, hashlib.sha256(text.encode()).hexdigest()


def _solved(kind: pa.DataType, segment: int):
    """Results of conversations that lie within a task; of others (its first, its last, long ones) segments."""
    row_kind = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
    kinds = [kind, pa.bool_(), pa.int32(), pa.int32(), row_kind, pa.list_(pa.binary()), *[pa.int64()] * 6, pa.string(), pa.string()]
    names = ["conv_id", "closed", "part", "seg", "rows", "digests", *NAMES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), []
        nothing = object()
        conv, rows, size, seg, first = nothing, [], 0, 0, True

        def opened() -> tuple:
            told = [dict(zip(("turn", "role", "text"), row)) for row in rows]
            return (conv, False, part, seg, told, list({digest(r, t) for _, r, t in rows}), *[None] * len(NAMES))

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            for conv_id, turn, there, role, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if conv is nothing or conv_id != conv:
                    if conv is not nothing:
                        out.append(opened() if first or seg else (conv, True, part, 0, None, None, *_solution(rows)))
                        first = False
                    conv, rows, size, seg = conv_id, [], 0, 0
                if len(rows) >= segment or size >= SEGMENT_BYTES:
                    out.append(opened())
                    rows, size, seg = [], 0, seg + 1
                if there:
                    rows.append((turn, role, text))
                    size += len(text)
                if len(out) >= 512 or size >= SEGMENT_BYTES and out:
                    yield batch_of(out)
                    out = []
        if conv is not nothing:
            out.append(opened())
        if out:
            yield batch_of(out)

    return run


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each segment, what chaining needs: cheapest edits from every state to every other, and its two ends."""
    step = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 7, *[pa.string()] * 2, pa.list_(step)]
    names = ["key", "part", "seg", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last", "steps"]
    for batch in batches:
        for one in batch.to_pylist():
            rows = [(r["turn"], r["role"], r["text"]) for r in one["rows"]]
            told, counts = faults(rows, one["earlier"] or ())
            turns = sorted({r[0] for r in rows if r[0] is not None})
            steps = [
                {"start": start, "stop": stop, "cost": cost, "audit": trail.text()}
                for start in range(4)
                for stop, (cost, trail) in edited(told, start, opening=False).items()
            ]
            initials = [t[0] for t in told]
            ends = (turns[0], turns[-1]) if turns else (None, None)
            heads = (initials[0], initials[-1]) if initials else (None, None)
            row = (one["key"], one["part"], one["seg"], *ends, len(turns), *counts, illegal_pairs(initials), *heads, steps)
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


_SUMMARY = (
    "key string, part int, seg int, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, steps array<struct<start: int, stop: int, cost: bigint, audit: string>>"
)
_CHAINED = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, path array<struct<part: int, seg: int, start: int, audit: string>>"


class _Chain:
    """The segments of one conversation so far; a node's mark is the state that its segment began in."""

    def __init__(self, key: str):
        root = Trail()
        self.key, self.places = key, []
        self.states: States = {0: (0, Trail(root)), 2: (INSERT, Trail(root, "I")), 3: (2 * INSERT, Trail(root, "II"))}
        self.low = self.high = self.last = None
        self.turns, self.counts, self.illegal = 0, [0, 0, 0], 0

    def add(self, one: dict) -> None:
        after: States = {}
        for step in one["steps"]:
            if step["start"] in self.states:
                cost, trail = self.states[step["start"]]
                _offer(after, step["stop"], cost + step["cost"], trail, step["audit"], step["start"])
        self.states = after
        self.places.append((one["part"], one["seg"]))
        if one["low"] is not None:
            self.turns += one["turns"] - (one["low"] == self.high)
            self.low, self.high = one["low"] if self.low is None else self.low, one["high"]
        self.counts = [a + one[b] for a, b in zip(self.counts, ("blank", "duplicate", "truncated"))]
        self.illegal += one["illegal"]
        if one["first"] is not None:
            if self.last is not None:
                self.illegal += illegal_pairs([self.last, one["first"]])
            self.last = one["last"]

    def row(self) -> tuple:
        cost, trail = best(self.states)
        begun, *steps = trail.nodes()
        path = [{"part": part, "seg": seg, "start": node.mark, "audit": node.piece} for (part, seg), node in zip(self.places, steps)]
        path[0] |= {"start": 0, "audit": begun.piece + path[0]["audit"]}
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return self.key, gaps, *self.counts, self.illegal, cost, trail.text(), path


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals and the path through its segments of each conversation; segments come in order."""
    place = pa.struct([("part", pa.int32()), ("seg", pa.int32()), ("start", pa.int32()), ("audit", pa.string())])
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.list_(place)]
    names = ["key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "path"]

    def row(chain: _Chain) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(chain.row(), kinds)], names=names)

    chain = None
    for batch in batches:
        for one in batch.to_pylist():
            if chain and chain.key != one["key"]:
                yield row(chain)
                chain = None
            chain = chain or _Chain(one["key"])
            chain.add(one)
    if chain:
        yield row(chain)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each conversation's repaired text; segments come in order and are held one at a time."""
    key, state, any_line = None, None, False

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "repaired_sha256"])

    for batch in batches:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1).to_pylist()[0]
            if one["key"] != key:
                if key is not None:
                    yield row()
                key, state, any_line = one["key"], hashlib.sha256(), False
            lines = repaired([(r["turn"], r["role"], r["text"]) for r in one["rows"]], one["audit"], one["start"])
            if lines:
                state.update((("\n" if any_line else "") + "\n".join(lines)).encode())
                any_line = True
    if key is not None:
        yield row()


def _in_order(segments: DataFrame) -> DataFrame:
    return segments.repartition("key").sortWithinPartitions("key", "part", "seg")


def conversations_repaired(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation after damage."""
    scratch = Scratch(rows.sparkSession, "conversations")
    hurt = damaged(rows)
    same = F.xxhash64("role", "text")
    order = ["conv_id", "turn", "role", same]
    dealt = hurt.repartitionByRange(*order).sortWithinPartitions(*order, "text", "there")
    kind = hurt.schema["conv_id"].dataType
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    schema = f"conv_id {kind.simpleString()}, closed boolean, part int, seg int, rows {_ROWS}, digests array<binary>, {RESULT}"
    solved = scratch.write("solved", dealt.mapInArrow(_solved(arrow, segment), schema))
    key: Column = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("none")).alias("key")
    opened = solved.where("NOT closed").select(key, "conv_id", "part", "seg", "rows", "digests")

    seen = opened.select("key", "part", "seg", F.explode("digests").alias("digest"))
    place = F.struct("part", "seg")
    firsts = seen.groupBy("key", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = seen.join(firsts, ["key", "digest"]).where(place > F.col("first"))
    earlier = later.groupBy("key", "part", "seg").agg(F.collect_list("digest").alias("earlier"))
    told = opened.select("key", "part", "seg", "rows").join(earlier, ["key", "part", "seg"], "left")
    summaries = told.select("key", "part", "seg", "rows", "earlier").mapInArrow(_summaries, _SUMMARY)
    chained = scratch.write("chained", _in_order(summaries).mapInArrow(_chained, _CHAINED))

    steps = chained.select("key", F.explode("path").alias("at")).select("key", "at.*")
    edits = opened.select("key", "part", "seg", "rows").join(steps, ["key", "part", "seg"])
    hashes = _in_order(edits.select("key", "part", "seg", "rows", "start", "audit")).mapInArrow(_hashed, "key string, repaired_sha256 string")
    names = opened.select("key", "conv_id").distinct()
    long = names.join(chained.drop("path"), "key").join(hashes, "key").select("conv_id", *NAMES)
    return solved.where("closed").select("conv_id", *NAMES).unionByName(long)
