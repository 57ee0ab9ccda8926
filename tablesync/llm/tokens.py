"""Whole texts to token ids, as the tokenizers library gives them.

A tokenizer of the kind described at ``PIECES`` never joins a letter with other ASCII characters or with white space.
For it the texts are cut at such places, each distinct piece is encoded by the library once, and the ids of the texts
are gathered from those of their pieces. Any other tokenizer, and any text that holds the string of a special token,
is given to the library as it is. The ids are the same either way.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: The normalizer and the pattern for which texts may be cut between an ASCII letter and another ASCII
#: character that is no apostrophe, and at ASCII white space.
PIECES = {
    "normalizers": ["NFC", "Replace", "Lowercase"],
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}
WHITE, LETTER, OTHER, STICKY = range(4)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of text and pieces that are handled at a time, pieces that are kept, and their ids: they bound a worker's memory.
_CHUNK = 1 << 19
_BATCH = 512
_KEPT = 2_000_000
_KEPT_IDS = 8_000_000


def _classes() -> np.ndarray:
    kinds = np.full(256, STICKY, np.uint8)
    kinds[:128] = OTHER
    kinds[[9, 10, 11, 12, 13, 32]] = WHITE
    for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz":
        kinds[c] = LETTER
    kinds[ord("'")] = STICKY
    return kinds


_KINDS = _classes()


class Encoder:
    """Token ids of batches of texts. ``end`` is appended to each text, if given."""

    def __init__(self, path: str, end: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.cut = _cuttable(spec) and bool(self.special)
        suffix = spec["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        self.parting = spec["added_tokens"][0]["id"] if self.special else None
        self.vocabulary = max(self.tokenizer.get_vocab_size(), (end or 0) + 1)
        self._clear()
        self._powers(_CHUNK)

    def _clear(self) -> None:
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int32)  # keys in order, and where each piece is
        self.flat, self.used, self.kept = np.empty(1 << 16, np.uint32), 0, 0
        self.first, self.count = np.empty(1 << 14, np.int32), np.empty(1 << 14, np.int32)

    def _powers(self, n: int) -> None:
        self.up, self.down = (np.cumprod(np.full(n, x, np.uint64)) for x in (_BASE, _BACK))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [None] * len(texts)
        whole, chunk, size = [], [], 0
        for k, text in enumerate(texts):
            if not self.cut or any(s in text for s in self.special):
                whole.append(k)
                continue
            chunk.append(k)
            size += len(text) + 1
            if size > _CHUNK:
                self._pieces(texts, chunk, out)
                chunk, size = [], 0
        if chunk:
            self._pieces(texts, chunk, out)
        for k in range(0, len(whole), 64):
            some = whole[k : k + 64]
            for at, got in zip(some, self._library([texts[i] for i in some])):
                out[at] = self._ended(np.array(got, np.uint32))
        return out

    def _library(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]

    def _ended(self, ids: np.ndarray) -> np.ndarray:
        return ids if self.end is None else np.append(ids, np.uint32(self.end))

    def _pieces(self, texts: list[bytes], chunk: list[int], out: list) -> None:
        joined = b"\n".join(texts[k] for k in chunk) + b"\n"
        begin = np.cumsum([0] + [len(texts[k]) + 1 for k in chunk])
        b = np.frombuffer(joined, np.uint8)
        kind = _KINDS[b]
        before = np.concatenate((np.zeros(1, np.uint8), kind[:-1]))
        starts = (kind != WHITE) & ((before == WHITE) | ((kind ^ before) == (LETTER ^ OTHER)))
        bounds = np.flatnonzero(starts | ((kind == WHITE) & (before != WHITE)))
        opening = kind[bounds] != WHITE
        start = bounds[opening]
        end = np.append(bounds[1:], len(b))[opening]
        if not len(start):
            for k in chunk:
                out[k] = self._ended(np.empty(0, np.uint32))
            return
        if len(b) > len(self.up):
            self._powers(len(b))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[: len(b)])))
        key = (sums[end] - sums[start]) * self.down[start]
        key = (key ^ (key >> np.uint64(29))) * _BASE + (end - start).astype(np.uint64)
        coded = pa.array(key).dictionary_encode()
        distinct, piece = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        where = np.empty(len(distinct), np.int64)
        where[piece[::-1]] = np.arange(len(piece) - 1, -1, -1)
        sticky = np.append(0, np.cumsum(kind == STICKY))
        words = (kind[start[where]] == LETTER) & (sticky[end[where]] == sticky[start[where]])
        slot = self._slots(distinct, joined, start[where], end[where], words)[piece]
        count = self.count[slot].astype(np.int64)
        after = np.cumsum(count)
        ids = self.flat[np.repeat(self.first[slot] - (after - count), count) + np.arange(after[-1])]
        edge = np.concatenate((np.zeros(1, np.int64), after))[np.searchsorted(start, begin)]
        for k, (low, high) in zip(chunk, zip(edge[:-1], edge[1:])):
            out[k] = self._ended(ids[low:high])

    def _new(self, pieces: list[bytes], words: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after another, and their numbers. The library gets many pieces at once: words parted by a
        space, as each ends with an id that ends words, other pieces by a special token."""
        flat, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(pieces), _BATCH):
            some = pieces[k : k + _BATCH]
            ids = np.array(self._library([(b" " if words else self.special[0]).join(some)])[0], np.uint32)
            if words:
                count = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
                if len(count) != len(some):  # not the kind of words that this holds for
                    return self._new(pieces, False)
            else:
                parted = ids == self.parting
                count = np.diff(np.flatnonzero(parted), prepend=-1, append=len(ids)) - 1
                ids = ids[~parted]
            counts.append(count)
            flat.append(ids)
        return np.concatenate(flat), np.concatenate(counts)

    def _slots(self, keys: np.ndarray, joined: bytes, start: np.ndarray, end: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Places of the pieces among the encoded ones; new pieces are encoded first. ``words``: of ASCII letters only."""
        if self.kept > _KEPT or self.used > _KEPT_IDS:
            self._clear()
        place = np.searchsorted(self.keys, keys)
        held = place < len(self.keys)
        held[held] = self.keys[place[held]] == keys[held]
        slot = np.full(len(keys), -1, np.int64)
        slot[held] = self.slots[place[held]]
        new = np.flatnonzero(~held)
        if len(new):
            n = self.kept
            new = np.concatenate((new[words[new]], new[~words[new]]))
            pieces = [joined[s:e] for s, e in zip(start[new].tolist(), end[new].tolist())]
            n_words = int(words[new].sum())
            both = self._new(pieces[:n_words], True), self._new(pieces[n_words:], False)
            flat, count = (np.concatenate(x) for x in zip(*both))
            self.flat = _room(self.flat, self.used + len(flat))
            self.flat[self.used : self.used + len(flat)] = flat
            self.first, self.count = _room(self.first, n + len(new)), _room(self.count, n + len(new))
            self.first[n : n + len(new)] = self.used + np.cumsum(count) - count
            self.count[n : n + len(new)] = count
            self.used, self.kept = self.used + len(flat), n + len(new)
            slot[new] = np.arange(n, n + len(new))
            order = new[np.argsort(keys[new])]
            self.keys = np.insert(self.keys, place[order], keys[order])
            self.slots = np.insert(self.slots, place[order], slot[order].astype(np.int32))
        return slot


def _room(array: np.ndarray, n: int) -> np.ndarray:
    if n <= len(array):
        return array
    grown = np.empty(max(n, len(array) + len(array) // 2), array.dtype)
    grown[: len(array)] = array
    return grown


def _cuttable(spec: dict) -> bool:
    steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    before = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    return steps == PIECES["normalizers"] and before.get("pattern", {}).get("Regex") == PIECES["pattern"] and before.get("behavior") == "Removed"


@lru_cache(maxsize=2)
def encoder(path: str, end: int | None = None) -> Encoder:
    """The encoder of this Python worker; it keeps what it has encoded from task to task."""
    return Encoder(path, end)
