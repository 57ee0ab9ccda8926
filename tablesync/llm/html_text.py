"""Main text of web pages, with boilerplate found by suffix arrays of a host's pages.

A page is read once, into blocks of text, each with where it stands: in an article, in a part that by its tag, role or class is no
article (menus, headers, footers, sidebars, notices, adverts, forms, comments), or neither. Blocks in parts go, as comments
are unique and yet no main text; so do articles in parts, such as teasers, unless a page has nothing else. A class or an id names a
part only if all its words fit one (``has-widget`` and ``social-history`` do not), and never a container with most of the page's text, unless an
article stands outside it.

The token streams of a host's blocks are concatenated, their suffixes sorted by prefix doubling, and common prefixes of
neighbours computed from the ranks. Neighbours that share ``Settings.run`` tokens and more are the places of a repeated substring, and
what such substrings cover is boilerplate if they stand on several distinct pages; pages of equal text are copies of one page and
count once. Where a block stands is evidence beside that: in an article a whole block must stand on more pages to be cut, as
articles quote each other, and a stretch within a block on even more. What is left of a page are its unique runs.

Hosts are cut into shards of a bounded number of pages and bytes, each with a suffix array of its own: a hot host is many
tasks, and a shard fits in memory. Blocks are shuffled once, compressed, into a table with a row for each shard, and all passes read
that.
Pages are counted over the whole host, so results do not depend on the shards: a run on enough pages of the host stands on the mean
number for a shard in one of them at least. So the arrays of the shards give candidates, as 64-bit hashes of host and run;
counting them in all shards and cutting those that are on enough pages take a hash of each window of tokens. Candidates are
broadcast if there are at most ``MANY_RUNS``; else all runs of large hosts are counted, and those to be cut are joined by host.

Null html is empty and gives the empty text. Pages without a readable host share the empty host's shards. Repeated rows
give equal texts. An empty table gives an empty result. Columns beside identifier, url and html are not looked at.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tablesync.llm.common import Scratch, batch_parts, whole


@dataclass(frozen=True)
class Settings:
    run: int = 6
    #: Distinct pages that a run must stand on: at least so many, and this share of the host's.
    pages: int = 3
    share: float = 0.02
    #: The same for a block in an article, and the share for a run within a block.
    article_pages: int = 10
    article_share: float = 0.3
    within_share: float = 0.35
    shard_pages: int = 200
    shard_bytes: int = 4 << 20


MANY = 50_000
MANY_RUNS = 4_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_UNMIX = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: HTML elements by what they do to text.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
PARTS = set("nav header footer aside form dialog menu button select svg canvas object audio video map fieldset head".split())
ARTICLES = {"article", "main"}
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification popup modal "
    "overlay newsletter subscribe signup sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead toolbar share sharing "
    "social related recommended recommendations comment comments disqus reply replies respond widget login search skip".split()
)

#: Words that stand beside these in names of parts.
BESIDE = set(
    "site page main top bottom left right upper lower global primary secondary box block area wrap wrapper container content inner outer section list item items "
    "link links bar row col column unit slot zone panel header head title body text button buttons icon icons form input field post posts article articles entry "
    "message policy by author v m xs sm md lg js is".split()
)

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!/?a-zA-Z][^>]*+(?:>|\Z)|[^<]++|<", re.S
)
_NAME = re.compile(r"""(?:^|[\s"'])(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
IN_ARTICLE, IN_PART, NEITHER = "article", "part", "neither"


STRONG, WEAK, ARTICLE = range(3)


def _names_part(name: str) -> bool:
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    return bool(NAMES.intersection(words)) and all(w in NAMES or w in BESIDE for w in words)


def _kind(tag: str, rest: str, in_article: bool) -> int | None:
    """What an element starts, if anything: a part by tag, role or being hidden, a part by its names, or an article."""
    if tag in PARTS and not (tag == "header" and in_article):
        return STRONG
    weak = False
    for name, value in _NAME.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return STRONG
        if name == "role" and value in ROLES:
            return STRONG
        weak = weak or name in ("class", "id") and tag not in ("html", "body") and any(map(_names_part, value.split()))
    return WEAK if weak else ARTICLE if tag in ARTICLES else None


class _Element:
    """An open part or article, and how often its tag is open in it."""

    __slots__ = ("tag", "kind", "depth", "size", "outside")

    def __init__(self, tag: str, kind: int):
        self.tag, self.kind, self.depth, self.size, self.outside = tag, kind, 1, 0, 0


def blocks(page: str) -> list[tuple[str, str]]:
    """Where it stands, and text with single spaces, of each block that has text, in page order."""
    out: list[tuple[str, tuple[_Element, ...]]] = []
    held: list[str] = []
    around: list[_Element] = []
    raw = ""

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split()) if held else ""
        held.clear()
        if text:
            out.append((text, tuple(around)))

    for piece in _PIECE.finditer(page):
        tag = piece["tag"]
        if tag is None:
            if not raw and (piece[0][0] != "<" or piece[0] == "<"):
                held.append(piece[0])
            continue
        tag, ends = tag.lower(), bool(piece["end"])
        if raw:
            raw = "" if ends and tag == raw else raw
            continue
        if tag in RAW:
            if not ends and not piece["rest"].endswith("/"):
                raw = tag
            continue
        if tag in ("br", "td", "th"):
            held.append(" ")
        if tag in BLOCKS or tag in PARTS:
            flush()
        if tag in VOID:
            continue
        if ends:
            for k, element in enumerate(around):
                if element.tag == tag:
                    element.depth -= 1
                    if not element.depth:
                        flush()
                        del around[k:]
                        break
            continue
        for element in around:
            element.depth += element.tag == tag
        kind = _kind(tag, piece["rest"], any(e.kind == ARTICLE for e in around))
        if kind is not None:
            flush()
            around.append(_Element(tag, kind))
    flush()
    return _placed(out)


def _placed(out: list[tuple[str, tuple[_Element, ...]]]) -> list[tuple[str, str]]:
    """Places of blocks, once the whole page is known."""
    shown = [(len(text), inside) for text, inside in out if not any(e.kind == STRONG for e in inside)]
    total = sum(n for n, _ in shown)
    articles = sum(n for n, inside in shown if any(e.kind == ARTICLE for e in inside))
    for n, inside in shown:
        for k, element in enumerate(inside):
            element.size += n
            # how much of it is in articles that stand within it
            element.outside += n if any(e.kind == ARTICLE for e in inside[k + 1 :]) else 0

    def is_part(element: _Element) -> bool:
        """Names do not make a part of what holds most of the page, unless an article stands outside it."""
        if element.kind != WEAK:
            return element.kind == STRONG
        return 2 * element.size <= total or articles > element.outside

    found, spare = [], []
    for text, inside in out:
        last = max((k for k, e in enumerate(inside) if is_part(e)), default=-1)
        within = any(e.kind == ARTICLE for e in inside)
        found.append((IN_PART if last >= 0 else IN_ARTICLE if within else NEITHER, text))
        spare.append(last >= 0 and any(e.kind == ARTICLE for e in inside[last + 1 :]))
    if any(place != IN_PART for place, _ in found):
        return found
    return [(IN_ARTICLE if alone else place, text) for (place, text), alone in zip(found, spare)]


def sorted_suffixes(tokens: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of the pages in order, how many tokens each shares with the one before, and how many tokens it has.

    Ranks by the first 1, 2, 4, ... tokens are doubled until no two suffixes are equal or the longest page is reached; only suffixes
    that still have equals are sorted again. A suffix ends with its page, and the shorter of two that agree comes first.
    """
    n = len(tokens)
    end = np.searchsorted(page, page, side="right")
    longest = int((end - np.arange(n)).max())
    order = np.argsort(tokens, kind="stable")
    first = np.append(True, tokens[order][1:] != tokens[order][:-1])
    rank = np.empty(n, np.int64)  # where the suffixes that are equal so far begin in the order
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    ranks, length = [rank], 1
    tied = np.flatnonzero(~(first & np.append(first[1:], True)))  # places in the order
    while length < longest and len(tied):
        some = order[tied]
        after = np.zeros(len(some), np.int64)
        inside = some + length < end[some]
        after[inside] = rank[some[inside] + length] + 1
        old = rank[some]
        again = np.lexsort((after, old))
        some, after, old = some[again], after[again], old[again]
        order[tied] = some
        fresh = np.append(True, (old[1:] != old[:-1]) | (after[1:] != after[:-1]))
        rank = rank.copy()
        rank[some] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(some)), 0))]
        ranks.append(rank)
        tied = tied[~(fresh & np.append(fresh[1:], True))]
        length *= 2
    shared = np.zeros(n, np.int64)
    pairs = np.arange(1, n)
    few = 2  # levels for neighbours that differ early: most
    if len(ranks) > few:
        i, j = order[:-1], order[1:]
        long = (i + (1 << few) <= end[i]) & (j + (1 << few) <= end[j]) & (ranks[few][i] == ranks[few][j])
        _share(pairs[long], order, end, ranks, shared)
        _share(pairs[~long], order, end, ranks[:few], shared)
    else:
        _share(pairs, order, end, ranks, shared)
    return order, shared, (end - np.arange(n))[order]


def _share(pairs: np.ndarray, order: np.ndarray, end: np.ndarray, ranks: list[np.ndarray], shared: np.ndarray) -> None:
    """Fill in how many tokens the suffixes at these places share with those before, which are less than the ranks tell apart."""
    i, j = order[pairs - 1].copy(), order[pairs].copy()
    stop_i, stop_j = end[i], end[j]
    for k in range(len(ranks) - 1, -1, -1):
        step = 1 << k
        same = np.flatnonzero((i + step <= stop_i) & (j + step <= stop_j))
        same = same[ranks[k][i[same]] == ranks[k][j[same]]]
        i[same] += step
        j[same] += step
        shared[pairs[same]] += step


def runs(tokens: np.ndarray, page: np.ndarray, run: int, alike: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where runs start, the number of each start's run, and on how many distinct pages each run stands.

    Neighbours in the order of suffixes that share ``run`` tokens and more are places of one run. ``alike`` numbers pages so that
    copies share a number, and only ``counted`` tokens make their page count.
    """
    none = np.zeros(0, np.int64)
    if len(tokens) < run:
        return none, none, none
    order, shared, left = sorted_suffixes(tokens, page)
    group = np.cumsum(shared < run)[left >= run]
    order = order[left >= run]
    if not len(order):
        return none, none, none
    by_page = np.lexsort((~counted[order], alike[order], group))
    order, group = order[by_page], group[by_page]
    first = np.append(True, group[1:] != group[:-1])
    fresh = first | np.append(True, alike[order][1:] != alike[order][:-1])
    group = np.cumsum(first) - 1
    return order, group, np.bincount(group, fresh & counted[order]).astype(np.int64)


def covered_by(starts: np.ndarray, run: int, n: int) -> np.ndarray:
    """Which of n tokens lie in the runs that start at these."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + run, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated(tokens: np.ndarray, page: np.ndarray, run: int, pages: int) -> np.ndarray:
    """Which tokens lie in a run that stands on so many distinct pages."""
    starts, group, on = runs(tokens, page, run, page, np.ones(len(page), bool))
    return covered_by(starts[on[group] >= pages], run, len(tokens))


#: How often a run stands on a host: enough to be cut beside articles, as a whole block of one, or within such a block.
BESIDE_ARTICLES, WHOLE_BLOCK, WITHIN_BLOCK = 1, 2, 3


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def word_hashes(words: pa.StringArray) -> np.ndarray:
    """64-bit hashes of distinct words, from running sums over their bytes."""
    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64) + np.uint64(1)
    start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    up, down = (np.cumprod(np.full(len(data) + 1, x, np.uint64)) for x in (_MIX, _UNMIX))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data * up[: len(data)])))
    key = (sums[end] - sums[start]) * down[start]
    return (key ^ (key >> np.uint64(29))) * _MIX + (end - start).astype(np.uint64)


#: Places of blocks that are stored, by number.
PLACES = (IN_ARTICLE, NEITHER)


def packed(page: str) -> tuple[bytes, bytes, int]:
    """Places and texts of a page's blocks outside parts, the texts joined by line breaks, which none holds; and 63 bits of the texts,
    equal for copies of a page."""
    found = [b for b in blocks(page) if b[0] != IN_PART]
    text = "\n".join(t for _, t in found).encode("utf-8", "replace")
    return bytes(PLACES.index(place) for place, _ in found), text, _hash(text) >> 1


class Shard:
    """Blocks outside parts of pages (places, text, content) of a host, or of some of them, as one stream of tokens. Of copies of a page
    the first one counts, unless a shard elsewhere holds the one that does: ``foreign``."""

    def __init__(self, pages: list[tuple[bytes, bytes, int]], settings: Settings, foreign: np.ndarray | None = None):
        self.settings = settings
        self.texts_ = [t.decode() for _, text, _ in pages if text for t in text.split(b"\n")]
        self.place = np.frombuffer(b"".join(p for p, _, _ in pages), np.uint8)
        self.block_page = np.repeat(np.arange(len(pages)), [len(p) for p, _, _ in pages])
        words = pc.split_pattern(pa.array(self.texts_, pa.large_string()), " ")
        self.count = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64) if len(words) else np.zeros(0, np.int64)
        coded = words.flatten().cast(pa.string()).dictionary_encode()
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # the edges of a block are tokens too
        self.start = np.cumsum(self.count + 2) - self.count - 2
        self.tokens = np.zeros(len(ids) + 2 * len(self.count), np.int64)
        self.tokens[np.repeat(self.start + 1 - (np.cumsum(self.count) - self.count), self.count) + np.arange(len(ids))] = ids + 1
        self.page = np.repeat(self.block_page, self.count + 2)
        self.words = coded.dictionary
        contents, first, number = np.unique(np.array([c for _, _, c in pages], np.int64), return_index=True, return_inverse=True)
        counted = np.zeros(len(pages), bool)
        counted[first] = True
        if foreign is not None:
            counted &= ~foreign
        self.distinct, self.pages = len(contents), len(pages)
        self.alike, self.counted = number[self.page], counted[self.page]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return runs(self.tokens, self.page, self.settings.run, self.alike, self.counted)

    def windows(self, host: str) -> tuple[np.ndarray, np.ndarray]:
        """Places of all windows of ``run`` tokens that end in their page, and hashes of host and window, equal in all shards."""
        n, run = len(self.tokens), self.settings.run
        if n < run:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.page[: n - run + 1] == self.page[run - 1 :])
        word = np.concatenate((np.full(1, _UNMIX), word_hashes(self.words)))[self.tokens]
        key = np.full(len(at), _hash(host.encode("utf-8", "replace")), np.uint64)
        for k in range(run):
            key = (key ^ word[at + k]) * _MIX
            key ^= key >> np.uint64(31)
        return at, key.view(np.int64)

    def texts(self, starts: np.ndarray, levels: np.ndarray) -> list[str]:
        """Main texts without the runs that start at these places and may be cut up to these levels."""
        run, n = self.settings.run, len(self.tokens)
        covers = {level: covered_by(starts[levels >= level], run, n) for level in (BESIDE_ARTICLES, WHOLE_BLOCK, WITHIN_BLOCK)}
        words_in = {}
        for level, cover in covers.items():
            sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(cover)))
            words_in[level] = sums[self.start + 1 + self.count] - sums[self.start + 1]
        article = self.place == PLACES.index(IN_ARTICLE)
        whole_ = article & (words_in[WHOLE_BLOCK] == self.count)
        some = np.where(article, words_in[WITHIN_BLOCK], words_in[BESIDE_ARTICLES]) > 0
        kept: list[list[str]] = [[] for _ in range(self.pages)]
        for b, (page, gone, cut) in enumerate(zip(self.block_page.tolist(), whole_.tolist(), some.tolist())):
            if gone:
                continue
            text = self.texts_[b]
            if cut:
                at = self.start[b] + 1
                cover = covers[WITHIN_BLOCK if article[b] else BESIDE_ARTICLES][at : at + self.count[b]]
                text = " ".join(w for w, c in zip(text.split(" "), cover.tolist()) if not c)
            if text:
                kept[page].append(text)
        return ["\n".join(k) for k in kept]


def _least(distinct, settings: Settings) -> tuple[int, int, int]:
    """Pages that a run must stand on for each level."""
    s = settings
    return tuple(max(least, math.ceil(share * distinct)) for least, share in ((s.pages, s.share), (s.article_pages, s.article_share), (s.article_pages, s.within_share)))


def _whole_host(pages: list[tuple[bytes, bytes, int]], settings: Settings) -> list[str]:
    shard = Shard(pages, settings)
    starts, group, on = shard.runs()
    return shard.texts(starts, np.searchsorted(_least(shard.distinct, settings), on, side="right")[group])


def main_texts(pages: list[str], settings: Settings = Settings()) -> list[str]:
    """Main text of each page of one host."""
    return _whole_host([packed(p) for p in pages], settings)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as blocks outside parts: host, shard, shards, row, page_id, url, content, places, body (compressed)."""
    names = ["host", "shard", "shards", "row", "page_id", "url", "content", "places", "body"]
    packer = zstandard.ZstdCompressor(3)
    for batch in batches:
        for part in batch_parts(batch):
            found = [packed(p) for p in part.column(6).to_pylist()]
            columns = [
                pa.array([f[2] for f in found], pa.int64()),
                pa.array([f[0] for f in found], pa.binary()),
                pa.array([packer.compress(f[1]) if f[1] else b"" for f in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*part.columns[:6], *columns], names=names)


def _gathered(page_type: pa.DataType):
    """One row for each shard, from rows sorted by host, shard and row."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(page_type)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shards, pages = None, None, []

        def row() -> pa.RecordBatch:
            columns = [pa.array([v], k) for v, k in zip((*at, shards, pages), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["host", "shard", "shards", "pages"])

        for batch in batches:
            for part in batch_parts(batch):
                for r in part.to_pylist():
                    key = r.pop("host"), r.pop("shard")
                    if at != key:
                        if pages:
                            yield row()
                        at, pages = key, []
                    shards = r.pop("shards")
                    pages.append(r)
        if pages:
            yield row()

    return run


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict], list[tuple[bytes, bytes, int]]]]:
    """A shard at a time: its row, its pages, and these as `Shard` takes them."""
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            pages = row.pop("pages")
            yield row, pages, [(p["places"], unpacker.decompress(p["body"]) if p["body"] else b"", p["content"]) for p in pages]


def _foreign(row: dict, pages: list[dict], wanted) -> np.ndarray:
    """Pages whose copy in another shard counts."""
    held = wanted.value if wanted is not None else np.sort(np.array(row["elsewhere"] or [], np.int64))
    return np.isin(np.array([p["row"] for p in pages], np.int64), held)


def _often(settings: Settings, elsewhere):
    """Hashes of runs that stand on ``enough`` pages of their shard, from its suffix array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, pages, found in _each(batches):
            if row["enough"] < 2:
                continue
            shard = Shard(found, settings, _foreign(row, pages, elsewhere))
            starts, group, on = shard.runs()
            at, keys = shard.windows(row["host"])
            first = np.unique(group, return_index=True)[1]
            chosen = starts[first][on >= row["enough"]]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(keys[np.searchsorted(at, chosen)]))], names=["run"])

    return run


def _pages_of_runs(settings: Settings, wanted, elsewhere):
    """On how many counted pages of a shard the wanted runs stand; all runs where a shard's mean is below two pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, pages, found in _each(batches):
            shard = Shard(found, settings, _foreign(row, pages, elsewhere))
            at, keys = shard.windows(row["host"])
            kept = shard.counted[at]
            if wanted is not None and row["enough"] >= 2:
                kept &= np.isin(keys, wanted.value)
            pairs = np.unique(np.stack((keys[kept], shard.page[at[kept]])), axis=1)
            run_, n = np.unique(pairs[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([row["host"]] * len(run_), pa.string()), pa.array(run_), pa.array(n)], names=["host", "run", "n"])

    return run


def _extracted(settings: Settings, kinds: list[pa.DataType], cut=None):
    """Main texts of the pages of each shard; the runs of large hosts that are to be cut are broadcast or in the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, pages, found in _each(batches):
            if row["shards"] is None:
                got = _whole_host(found, settings)
            else:
                if cut is not None:
                    runs_, levels = cut.value
                else:
                    cuts = sorted((c["run"], c["level"]) for c in row["cuts"] or ())
                    runs_, levels = (np.array([c[k] for c in cuts], np.int64) for k in (0, 1))
                shard = Shard(found, settings)
                at, keys = shard.windows(row["host"])
                level = np.zeros(len(keys), np.int64)
                if len(runs_):
                    place = np.minimum(np.searchsorted(runs_, keys), len(runs_) - 1)
                    level = np.where(runs_[place] == keys, levels[place], 0)
                got = shard.texts(at, level)
            columns = [pa.array([p[c] for p in pages], kind) for c, kind in zip(("page_id", "url"), kinds)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(got, pa.string())], names=["page_id", "url", "text"])

    return run


def _large_hosts(shards: DataFrame, settings: Settings, scratch: Scratch) -> tuple[DataFrame, object]:
    """The shards of large hosts, and what is to be cut of them: broadcast, or in a column ``cuts``."""
    spark, s = shards.sparkSession, settings
    copies = shards.select("host", "shard", "shards", F.explode(F.arrays_zip("pages.content", "pages.row")).alias("p"))
    local = copies.groupBy("host", "shard", "shards", "p.content").agg(F.min("p.row").alias("row"))
    owners = scratch.write("owners", local.groupBy("host", "shards", "content").agg(F.min("row").alias("row"), F.collect_list(F.struct("shard", "row")).alias("places")))
    on = lambda pages, share: F.greatest(F.lit(pages), F.ceil(F.lit(share) * F.col("distinct"))).cast("long")
    least = {"least": on(s.pages, s.share), "least_block": on(s.article_pages, s.article_share), "least_within": on(s.article_pages, s.within_share)}
    limits = owners.groupBy("host", "shards").agg(F.count("*").alias("distinct")).withColumns(least)
    limits = scratch.write("limits", limits.withColumn("enough", F.ceil(F.col("least") / F.col("shards"))).drop("shards", "distinct"))
    known = F.broadcast(limits) if limits.count() <= MANY else limits
    others = owners.where(F.size("places") > 1).select("host", F.col("row").alias("owner"), F.explode("places").alias("p")).where("p.row <> owner")
    others = scratch.write("others", others.select("host", "p.shard", "p.row"))
    elsewhere, rows = None, shards.join(known.select("host", "enough"), "host")
    if others.count() <= MANY_RUNS:
        elsewhere = spark.sparkContext.broadcast(np.sort(others.select("row").distinct().toArrow().column(0).to_numpy()))
    else:
        rows = rows.join(others.groupBy("host", "shard").agg(F.collect_list("row").alias("elsewhere")), ["host", "shard"], "left")
    often = scratch.write("often", rows.mapInArrow(_often(s, elsewhere), "run long").distinct())
    wanted = spark.sparkContext.broadcast(np.sort(often.toArrow().column(0).to_numpy())) if often.count() <= MANY_RUNS else None
    counts = rows.mapInArrow(_pages_of_runs(s, wanted, elsewhere), "host string, run long, n long").groupBy("host", "run").agg(F.sum("n").alias("n"))
    level = F.when(F.col("n") >= F.col("least_within"), WITHIN_BLOCK).when(F.col("n") >= F.col("least_block"), WHOLE_BLOCK).otherwise(BESIDE_ARTICLES)
    cut = scratch.write("cut", counts.join(known, "host").where("n >= least").select("host", "run", level.cast("long").alias("level")))
    if cut.count() <= MANY_RUNS:
        held = cut.select("run", "level").distinct().orderBy("run", "level").toArrow()
        runs_, levels = held.column("run").to_numpy(), held.column("level").to_numpy()
        return shards, spark.sparkContext.broadcast((runs_, levels))
    by_host = cut.groupBy("host").agg(F.collect_list(F.struct("run", "level")).alias("cuts"))
    return shards.join(by_host, "host", "left"), None


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html", settings: Settings = Settings()) -> DataFrame:
    """page_id, url, text, n_chars of every row; page_id and url keep their types."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(host.alias("host"), F.col(page_id).alias("page_id"), F.col(url).alias("url"), whole(body).alias("html"))
    weight = F.least(F.octet_length("html"), F.lit(settings.shard_bytes))  # a long page is one shard at most
    sizes = rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(weight).alias("bytes"))
    shards = F.greatest(F.ceil(F.col("n") / settings.shard_pages), F.ceil(F.col("bytes") / settings.shard_bytes))
    scratch = Scratch(pages.sparkSession, "hosts")
    large = scratch.write("large", sizes.select("host", shards.alias("shards")).where("shards > 1"))
    n = large.count()
    large = F.broadcast(large) if n <= MANY else large
    row = F.xxhash64("page_id", "url", "html").alias("row")
    dealt = rows.select("host", row, "page_id", "url", "html").join(large, "host", "left")
    dealt = dealt.select("host", F.pmod("row", F.coalesce("shards", F.lit(1))).alias("shard"), "shards", "row", "page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    id_, url_ = (f.type for f in to_arrow_schema(rows.select("page_id", "url").schema))
    typed = f"page_id {kinds['page_id']}, url {kinds['url']}"
    blocks_ = dealt.mapInArrow(_parsed, f"host string, shard long, shards long, row long, {typed}, content long, places binary, body binary")
    page = pa.struct([("row", pa.int64()), ("page_id", id_), ("url", url_), ("content", pa.int64()), ("places", pa.binary()), ("body", pa.binary())])
    fields = f"row: bigint, page_id: {kinds['page_id']}, url: {kinds['url']}, content: bigint, places: binary, body: binary"
    sorted_ = blocks_.repartition("host", "shard").sortWithinPartitions("host", "shard", "row")
    gathered = scratch.write("shards", sorted_.mapInArrow(_gathered(page), f"host string, shard long, shards long, pages array<struct<{fields}>>"))
    cut = None
    if n:
        many, cut = _large_hosts(gathered.where("shards IS NOT NULL"), settings, scratch)
        gathered = many.unionByName(gathered.where("shards IS NULL"), allowMissingColumns=True)
    texts = gathered.mapInArrow(_extracted(settings, [id_, url_], cut), f"{typed}, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
