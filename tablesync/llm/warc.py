"""WARC archives of pages, and a capture index merged from locally sorted runs.

A page becomes a record of its own gzip member, with an HTTP head and the whole page in UTF-8. Of pages of equal bytes, told by
SHA-256, the one of the smallest identifier is a ``response``; others are a ``revisit`` that names it and holds no payload.
Only the digests are grouped; payloads are not shuffled but to join them with the repeated digests, where these are too
many to broadcast.

Members are gathered in blocks of about ``BLOCK`` bytes, each a file that begins with a ``warcinfo`` record. Spark's text writer puts
them on any store it can write: a block is one value, and what it puts after each is an empty gzip member, so the
files are plain multi-member gzip. Readers take a file at a time; a digest that does not fit the payload is an error.

Reading an archive yields its captures, sorted by URL key (host labels reversed), time and identifier: one run per file, kept
on shared storage. Runs are cut by ranges of the key; in each range the slices of all runs are merged by a loser tree, whose
inner nodes hold the loser of each match, so the next capture costs one path to the root. Ranges in order give one
sorted index. A hot host or URL is cut by time and identifier. A task holds one range, never a whole run.

Null pages have an empty payload; a null URL has the empty key and no target header. Null identifiers are responses only if no page
of these bytes has one, and come first among captures of one key and time. Where an identifier repeats with equal
bytes, the smallest URL is the response, and one of wholly equal rows. Captures equal in key, time and identifier follow by
record type, then digest. An empty table gives no archive and an empty index. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import Scratch, dropping_shuffles, whole

BLOCK = 8 << 20
#: Fixed value of the file format: a gzip member of no bytes.
EMPTY_MEMBER = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
#: Fixed value of the file format: the profile of revisits.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_URL = re.compile(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?", re.I | re.S)


def url_key(url: str | None) -> str:
    """Host labels from the right, port, path and sorted parameters, in lower case; without scheme, user and fragment."""
    if not url:
        return ""
    found = _URL.match(url)
    if not found:
        return url.lower()
    host, port, path, query = found.groups()
    host = ",".join(reversed(re.sub(r"^www\d*\.", "", host.lower().rstrip(".")).split(".")))
    port = f":{port}" if port and port not in ("80", "443") else ""
    query = "?" + "&".join(sorted(query.lower().split("&"))) if query else ""
    return f"{host}{port}){path.lower() or '/'}{query}"


def _record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5('|'.join(map(str, parts)).encode()).digest())}>"


def _date(seconds: int) -> str:
    return (EPOCH + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def _member(heads: list[tuple[str, str]], block: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    lines = "".join(f"{name}: {value}\r\n" for name, value in [*heads, ("Content-Length", str(len(block)))])
    return packer.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def _opening(part: int, number: int) -> bytes:
    heads = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id("info", part, number)), ("WARC-Date", _date(0))]
    return _member([*heads, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def _archived(block: int):
    """Rows of page, URL, time, SHA-1, bytes, response and payload (null for revisits) as blocks of members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, files, held, size = TaskContext.get().partitionId(), 0, 0, [], 0
        for batch in batches:
            for page, url, captured, sha1, n, response, payload in zip(*(c.to_pylist() for c in batch.columns)):
                revisit, number = payload is None, number + 1
                heads = [("WARC-Type", "revisit" if revisit else "response")]
                heads.append(("WARC-Record-ID", _record_id("again", part, number, page) if revisit else _record_id(page, sha1)))
                heads.append(("WARC-Date", _date(captured)))
                if url is not None:
                    heads.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]%~")))
                heads.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()))
                heads.append(("Page-ID", "" if page is None else str(page)))
                if revisit:
                    heads += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(response, sha1)), ("Refers-To-Page", "" if response is None else str(response))]
                heads.append(("Content-Type", "application/http;msgtype=response"))
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
                if not held:
                    held.append(_opening(part, files))
                held.append(_member(heads, http + (payload or b"")))
                size += len(held[-1])
                if size >= block:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])
                    held, size, files = [], 0, files + 1
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])

    return run


def _placed(pages: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """Pages with ``response``, the identifier of the page they repeat, and whether they are a revisit."""
    large = pages.where(F.col("n") >= least)
    per_page = large.groupBy("sha", "page_id").agg(F.count("*").alias("copies"))
    owner = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "copies"))
    groups = per_page.groupBy("sha").agg(owner.alias("owner"), F.sum("copies").alias("rows")).where("rows > 1")
    shared = scratch.write("shared", groups.select("sha", F.col("owner.page_id").alias("response"), F.col("owner.copies").alias("copies")))
    found = pages.join(shared, "sha", "left")
    own = F.col("page_id").eqNullSafe(F.col("response"))
    told = found.withColumn("revisit", F.col("copies").isNotNull() & ~own)
    if shared.where("copies > 1").isEmpty():
        return told
    tied = F.col("copies").isNotNull() & own & (F.col("copies") > 1)
    per_url = found.where(tied).groupBy("sha", "page_id", "url", "captured", "sha1", "n", "response").agg(F.count("*").alias("rows"), F.first("payload").alias("payload"))
    first = F.row_number().over(Window.partitionBy("sha").orderBy("url", "captured")) == 1
    each = per_url.withColumn("first", first).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    rest = each.withColumn("revisit", ~(F.col("first") & (F.col("copy") == 1)))
    columns = ["page_id", "url", "captured", "sha1", "n", "response", "revisit", "payload"]
    return told.where(~tied).select(*columns).unionByName(rest.select(*columns))


def capture_time(page_id: str = "page_id") -> Column:
    """A stand-in for pages without a time: seconds of 2024 and later, by identifier."""
    return F.lit(1704067200) + F.coalesce(F.pmod(F.col(page_id), F.lit(10**9)), F.lit(0))


def write_archives(pages: DataFrame, path: str, captured: Column | None = None, least: int = 0, block: int = BLOCK) -> None:
    """Write a record per row of page_id, url, html to ``path``; payloads of fewer than ``least`` bytes are all responses."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    payload = F.encode(whole("html"), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        (capture_time() if captured is None else captured).cast("long").alias("captured"),
        payload.alias("payload"),
    )
    told = rows.select("*", F.sha2("payload", 256).alias("sha"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n"))
    placed = _placed(told, scratch, least)
    body = F.when(~F.col("revisit"), F.col("payload"))
    blocks = placed.select("page_id", "url", "captured", "sha1", "n", "response", body.alias("payload")).mapInArrow(_archived(block), "value binary")
    with dropping_shuffles(spark):
        files = blocks.select(F.col("value").cast("string").alias("value")).write.mode("overwrite")
        files.option("lineSep", EMPTY_MEMBER).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(path)
    scratch.drop("shared")


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Place, length and content of each gzip member."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpacker, parts, to = zlib.decompressobj(31), [], at
        while not unpacker.eof and to < len(view):
            some = view[to : to + (1 << 14)]
            parts.append(unpacker.decompress(some))
            to += len(some)
        if not unpacker.eof:
            raise ValueError(f"archive ends within the member at {at}")
        to -= len(unpacker.unused_data)
        yield at, to - at, b"".join(parts)
        at = to


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


_CAPTURES = (
    "run string, seq int, key binary, url_key string, captured long, page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, archive string, offset long, length long"
)
_NAMES = [c.split()[0] for c in _CAPTURES.split(", ")]
_KINDS = [{"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}[c.split()[1]] for c in _CAPTURES.split(", ")]


def _number(text: str) -> int | None:
    return int(text) if text else None


def _capture(record: bytes) -> tuple | None:
    fields, block = parsed(record)
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(http.rsplit(b"Content-Length: ", 1)[1])
    if kind == "response" and (len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    captured = int((datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc) - EPOCH).total_seconds())
    page, url = _number(fields["Page-ID"]), fields.get("WARC-Target-URI")
    key = url_key(url)
    place = b"\0" if page is None else b"\1" + struct.pack(">Q", page + (1 << 63))
    order = key.encode() + b"\0" + struct.pack(">Q", captured + (1 << 63)) + place + kind.encode() + digest.encode()
    return order, key, captured, page, url, kind, n, digest, _number(fields.get("Refers-To-Page", ""))


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted run of each archive."""
    for batch in batches:
        for k in range(batch.num_rows):
            archive = batch.column(0)[k].as_py()
            rows = []
            for at, length, record in members(batch.column(1)[k].as_buffer()):
                found = _capture(record) if record else None
                if found:
                    rows.append((*found, archive, at, length))
            rows.sort(key=lambda r: r[0])
            name = archive.rsplit("/", 1)[-1]
            columns = zip(*((name, seq, *row) for seq, row in enumerate(rows)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS)], names=_NAMES)


class LoserTree:
    """Merges sorted sequences; inner nodes hold losers, the top the sequence whose head comes next (ties: the earlier one)."""

    def __init__(self, slices: Sequence[Sequence]):
        self.slices, self.at = slices, [0] * len(slices)
        self.node = [-1] * len(slices)
        for k in range(len(slices)):
            self._play(k)

    def _less(self, a: int, b: int) -> bool:
        if self.at[a] >= len(self.slices[a]) or self.at[b] >= len(self.slices[b]):
            return self.at[b] >= len(self.slices[b]) and self.at[a] < len(self.slices[a])
        x, y = self.slices[a][self.at[a]], self.slices[b][self.at[b]]
        return x < y or x == y and a < b

    def _play(self, winner: int) -> None:
        k = (winner + len(self.slices)) // 2
        while k:
            held = self.node[k]
            if held < 0:
                self.node[k] = winner
                return
            if self._less(held, winner):
                self.node[k], winner = winner, held
            k //= 2
        self.node[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """Slice and place in it of one element after the other."""
        while self.slices:
            top = self.node[0]
            if self.at[top] >= len(self.slices[top]):
                return
            yield top, self.at[top]
            self.at[top] += 1
            self._play(top)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the key: the slices of all runs, one after the other, as one sorted sequence."""
    part, held = TaskContext.get().partitionId(), [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    runs, keys = rows.column("run").to_pylist(), rows.column("key").to_pylist()
    edges = [0, *(k for k in range(1, len(runs)) if runs[k] != runs[k - 1]), len(runs)]
    order = [edges[s] + k for s, k in LoserTree([keys[a:b] for a, b in zip(edges[:-1], edges[1:])])]
    kept = rows.drop_columns(["run", "seq", "key"])
    for at in range(0, len(order), 8192):
        some = kept.take(order[at : at + 8192]).combine_chunks()
        place = pa.table({"part": pa.array([part] * len(some), pa.int32()), "place": pa.array(range(at, at + len(some)), pa.int64())})
        for name in some.column_names:
            place = place.append_column(name, some.column(name))
        yield from place.combine_chunks().to_batches()


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """The captures of the archives in ``path``; in the order of ``part, place`` they are sorted by URL key, time and identifier."""
    scratch = Scratch(spark, "captures")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    runs = scratch.write("runs", files.select("path", "content").mapInArrow(_captures, _CAPTURES))
    ranges = runs.repartitionByRange("key").sortWithinPartitions("run", "seq")
    merged = "part int, place long, " + _CAPTURES.split("key binary, ")[1]
    index = scratch.write("index", ranges.mapInArrow(_merged, merged))
    scratch.drop("runs")
    return index
