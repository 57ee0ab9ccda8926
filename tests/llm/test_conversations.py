"""Repaired conversations against all edits tried one by one, and long conversations in segments against whole ones."""

from __future__ import annotations

import hashlib
import re
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.llm.conversations import Trail, best, comes_before, conversations_repaired, edited, repaired

SCHEMA = "conv_id long, turn long, role string, text string"
LAWFUL = re.compile(r"(s?(ua)+)?\Z")


def hurt(rows):
    """The contract's damage, row by row."""
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        yield from [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)


def plain(rows):
    """Least (cost, edits, text) of plain strings, each state with its whole string."""
    seen, told, counts = set(), [], [0, 0, 0]
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
        seen.add((role, text))
        told.append(fault)
        counts[fault : fault + 1] = [counts[fault] + 1] if fault < 3 else []
    moves = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}

    def inserts(states):
        for _ in range(2):
            for state, (cost, audit, lines) in list(states.items()):
                for role in ("user", "assistant"):
                    if state in moves[role[0]]:
                        put(states, moves[role[0]][state], (cost + 5, audit + "I", lines + (f"{role}:",)))
        return states

    def put(states, state, found):
        states[state] = min(states.get(state, found), found)

    states = inserts({"": (0, "", ())})
    for (_, _, role, text), fault in zip(rows, told):
        after = {}
        for state, (cost, audit, lines) in states.items():
            put(after, state, (cost + 2, audit + "D", lines))
            if fault < 2:
                continue
            more = cost + 5 * (fault == 2)
            if state in moves.get(role[:1], {}):
                put(after, moves[role[0]][state], (more, audit + "K", lines + (f"{role}:{text}",)))
            for new in ("user", "assistant"):
                if state in moves[new[0]]:
                    put(after, moves[new[0]][state], (more + 1, audit + "R", lines + (f"{new}:{text}",)))
        states = inserts(after)
    cost, audit, lines = min(states[s] for s in ("", "a") if s in states)
    return (*counts, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute(rows):
    by = {}
    for row in rows:
        by.setdefault(row[0], [])
    for row in hurt(rows):
        by[row[0]].append(row)
    for conv, some in by.items():
        some.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        turns = {r[1] for r in some if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        blank, duplicate, truncated, cost, audit, sha = plain(some)
        heads = [r[2][:1] for r in some]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
        yield conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha


def check(spark, rows, segment=2048):
    got = {tuple(r) for r in conversations_repaired(spark.createDataFrame(rows, SCHEMA), segment).collect()}
    assert got == set(brute(rows))


KINDS = st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans())


@settings(max_examples=60, deadline=None)
@given(st.lists(KINDS, max_size=3))
def test_edits_are_the_first_of_the_cheapest(rows):
    found = []
    for edits in product("KRD", repeat=len(rows)):
        cost, options = 0, [""]
        for (initial, must_go, truncated), edit in zip(rows, edits):
            cost += {"K": 0, "R": 1, "D": 2}[edit] + (5 if truncated and edit != "D" else 0) + (1000 if must_go and edit != "D" else 0)
            letters = {"K": [initial], "R": ["u", "a"], "D": [""]}[edit]
            options = [o + x for o in options for x in letters]
        for letters in options:
            found += with_inserts(cost, edits, letters)
    cost, trail = best(edited(rows))
    assert (cost, trail.text()) == min(found)


def with_inserts(cost, edits, letters):
    """Every way to put up to one user and one assistant row before each edit and at the end."""
    for extra in product(("", "u", "a", "ua", "au"), repeat=len(edits) + 1):
        if sum(map(len, extra)) > 3:
            continue
        order, audit, left = "", "", list(letters)
        for k, edit in enumerate(edits):
            order, audit = order + extra[k], audit + "I" * len(extra[k]) + edit
            if edit != "D":
                order += left.pop(0)
        order, audit = order + extra[-1], audit + "I" * len(extra[-1])
        if LAWFUL.match(order):
            yield cost + 5 * sum(map(len, extra)), audit


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("DIKR"), max_size=40), st.lists(st.sampled_from("DIKR"), max_size=40), st.integers(0, 40))
def test_trails_compare_as_their_strings(a, b, shared):
    root, trails = Trail(), []
    for letter in a[:shared]:
        root = Trail(root, letter)
    for rest in (a[shared:], b):
        node = root
        for letter in rest:
            node = Trail(node, letter)
        trails.append(node)
    assert comes_before(*trails) == (trails[0].text() < trails[1].text())


def test_equal_hashes_of_different_strings_do_not_decide(monkeypatch):
    monkeypatch.setattr("tablesync.llm.conversations.PRIME", 3)
    for a, b in product(product("DIKR", repeat=3), repeat=2):
        root = Trail()
        x = y = root
        for p, q in zip(a, b):
            x, y = Trail(x, p), Trail(y, q)
        if x.text() != y.text():
            assert comes_before(x, y) == (x.text() < y.text())


def test_repaired_rows_keep_their_roles():
    rows = [(0, "system", "x."), (1, "assistant", "y."), (2, "tool", "z.")]
    assert repaired(rows, "KIKD") == ["system:x.", "user:", "assistant:y."]


def test_conversations_with_every_fault(spark):
    texts = ["Yes.", "no", "", " \t", None, "Why?", "odd. ", "A.\x0b"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    rows = [(c, t, roles[(c * 7 + t * (c % 3 + 1)) % 8 if c % 2 else (t % 2) + 1], texts[(c * t + t) % 8]) for c in range(120) for t in range(c % 9)]
    rows += [(None, 0, "user", "a."), (None, None, "assistant", "b."), (5000, None, "user", "q"), (5001, 7, "user", "q.")]
    check(spark, rows)


@pytest.mark.parametrize("segment", [1, 2, 7])
def test_long_conversations_in_segments(spark, segment):
    words = ["a.", "b!", "c", "", "d?", "e."]
    rows = [(1, t // 2 * 3, ("user", "assistant", "system")[(t * t) % 3], words[(t * 5 + t // 7) % 6] + str(t % 11 if t % 4 else "")) for t in range(0, 200, 2)]
    rows += [(2, t, ("user", "assistant")[t % 2], f"w{t}.") for t in range(60)] + [(3, 0, "user", "x.")]
    check(spark, rows, segment)


def test_long_trails_share_their_beginnings():
    rows = [("ua"[k % 2], k % 7 == 0, k % 5 == 0) for k in range(20_000)]
    cost, trail = best(edited(rows))
    assert cost > 0 and len(trail.text()) >= 20_000


def test_no_rows_and_other_columns(spark):
    assert conversations_repaired(spark.createDataFrame([], SCHEMA)).count() == 0
    more = spark.createDataFrame([(1, 1, "user", "a.", "x", 3)], SCHEMA + ", key string, part int")
    assert [tuple(r)[0] for r in conversations_repaired(more).collect()] == [1]
    gone = next(t for t in range(100) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in conversations_repaired(spark.createDataFrame([(9, gone, "user", "a.")], SCHEMA)).collect()] == [(9, 0, 0, 0, 0, 0, 0, "", empty)]


def test_repeated_rows_are_duplicates(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"4:{t}".encode()) % 20 > 4)
    check(spark, [(4, turn, "user", "a.")] * 3)
