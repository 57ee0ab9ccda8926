"""A Patricia trie over byte strings that spills whole subtrees to disk when it outgrows its budget."""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

#: Of one text: most code points, smallest identifier with so many (None sorts last), rows, rows of that identifier.
Owner = tuple[int, "int | None", int, int]


def preferred(a: Owner, b: Owner) -> Owner:
    """The owner of two sets of equal texts: most code points, then the smallest identifier."""
    rank = lambda o: (-o[0], o[1] is None, o[1] or 0)
    best = min(a, b, key=rank)
    return best[0], best[1], a[2] + b[2], a[3] + b[3] if a[:2] == b[:2] else best[3]


class _Node:
    __slots__ = ("label", "kids", "owner")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.owner, self.kids = label, owner, {}


def _shared(label: bytes, key: bytes, at: int) -> int:
    """How many bytes of the label the key has from ``at`` on."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key.startswith(label[:mid], at):
            low = mid
        else:
            high = mid - 1
    return low


_HEAD = struct.Struct("<q?qqqq")


@dataclass
class _Spilled:
    file: object
    shared: bytes | None = None  # what all its keys begin with

    def add(self, key: bytes, owner: Owner) -> None:
        n = _shared(key, self.shared, 0) if self.shared is not None else len(key)
        self.shared = key[:n]
        most, smallest, rows, same = owner
        self.file.write(_HEAD.pack(most, smallest is None, smallest or 0, rows, same, len(key)))
        self.file.write(key)

    def read(self) -> Iterator[tuple[bytes, Owner]]:
        self.file.seek(0)
        while head := self.file.read(_HEAD.size):
            most, none, smallest, rows, same, n = _HEAD.unpack(head)
            yield self.file.read(n), (most, None if none else smallest, rows, same)


class Trie:
    """Terminal nodes hold the owner of one byte string; equal strings meet in one node, byte by byte.

    ``budget`` bounds the label bytes in memory (plus ``NODE`` a node). Beyond it the subtree of one first byte, the
    largest, moves to a temporary file of this task, and later strings of that subtree follow it there. Reading the
    trie then opens one spilled subtree at a time as a trie of its own, below the bytes that its strings share.
    """

    NODE = 300

    def __init__(self, budget: int = 256 << 20):
        self.root, self.budget = _Node(b""), budget
        self.weight: dict[int, int] = {}
        self.spilled: dict[int, _Spilled] = {}

    @property
    def size(self) -> int:
        return sum(self.weight.values())

    def insert(self, key: bytes, owner: Owner) -> None:
        if key and key[0] in self.spilled:
            self.spilled[key[0]].add(key, owner)
            return
        node, at = self.root, 0
        while at < len(key):
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids[key[at]] = _Node(key[at:], owner)
                self._grew(key[0], len(key) - at + self.NODE)
                return
            n = _shared(kid.label, key, at)
            if n < len(kid.label):
                mid = _Node(kid.label[:n])
                kid.label = kid.label[n:]
                mid.kids[kid.label[0]] = kid
                node.kids[key[at]] = kid = mid
                self._grew(key[0], self.NODE)
                if key[0] in self.spilled:
                    self.spilled[key[0]].add(key, owner)
                    return
            node, at = kid, at + n
        node.owner = preferred(node.owner, owner) if node.owner else owner

    def _grew(self, first: int, by: int) -> None:
        self.weight[first] = self.weight.get(first, 0) + by
        if self.size > self.budget and max(self.weight.values()) > self.NODE * 4:
            self._spill(max(self.weight, key=self.weight.get))

    def _spill(self, first: int) -> None:
        out = _Spilled(tempfile.TemporaryFile())
        for key, owner in _strings(self.root.kids.pop(first), b""):
            out.add(key, owner)
        self.spilled[first] = out
        del self.weight[first]

    def strings(self) -> Iterator[tuple[bytes, Owner]]:
        """Every distinct byte string with its owner."""
        for held, before in self._parts(b""):
            yield from _strings(held.root, before)

    def digests(self) -> Iterator[tuple[str, Owner]]:
        """Lower-case SHA-256 of every distinct byte string with its owner; shared prefixes are hashed once."""
        for held, before in self._parts(b""):
            yield from _digests(held.root, hashlib.sha256(before))

    def _parts(self, before: bytes) -> Iterator[tuple[Trie, bytes]]:
        yield self, before
        for spilled in self.spilled.values():
            below, n = Trie(self.budget), len(spilled.shared)
            for key, owner in spilled.read():
                below.insert(key[n:], owner)
            spilled.file.close()
            yield from below._parts(before + spilled.shared)


def _strings(node: _Node, before: bytes) -> Iterator[tuple[bytes, Owner]]:
    todo = [(node, before)]
    while todo:
        node, before = todo.pop()
        key = before + node.label
        if node.owner:
            yield key, node.owner
        todo.extend((kid, key) for kid in node.kids.values())


def _digests(node: _Node, before) -> Iterator[tuple[str, Owner]]:
    todo = [(node, before)]
    while todo:
        node, before = todo.pop()
        digest = before.copy()
        digest.update(node.label)
        if node.owner:
            yield digest.hexdigest(), node.owner
        todo.extend((kid, digest) for kid in node.kids.values())
