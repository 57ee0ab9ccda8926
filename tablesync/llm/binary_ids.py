"""Token ids in a compact binary form, written in ascending document order and read back.

Ids are replaced by their rank in the order of frequency over the whole corpus (ties: smaller id first), so that the
256 most frequent take one byte. A block holds whole documents: for four ids each one control byte with four two-bit
lengths, and apart from it the ids' one to four low bytes. Decoding looks control bytes up in a table of lengths.

The files are a Parquet table of blocks in folders ``part=k`` of ascending documents; readers and writers are Spark's, so
any store that Spark writes will do, and a lost task is just run again. ``ranks`` beside it holds the vocabulary by rank.

Documents are dealt into ranges by identifier and sorted there, once, as texts. Ids are kept in a table of their own
between counting and coding, as the ranks need all counts. What reaches the driver is one count for each vocabulary
entry and one sum for each part.

Null texts count as empty and have just the end id. Null identifiers come first; rows with equal identifiers are
ordered by text. An empty table gives empty files and an empty result. Columns beside identifier and text are not
looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import Scratch, batch_parts, dropping_shuffles, whole
from tablesync.llm.tokens import encoder

BLOCK_IDS = 1 << 16
#: Lengths of the four ids of each control byte.
LENGTHS = np.array([[1 + (c >> (2 * k) & 3) for k in range(4)] for c in range(256)], np.uint8)


def pack_ids(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    lengths = 1 + (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    codes = np.zeros(-len(values) % 4 + len(values), np.uint8)
    codes[: len(values)] = lengths - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    width = int(lengths.max(initial=1))  # bytes beyond it are not looked at
    kept = np.arange(width, dtype=np.uint8) < lengths[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[:, :width][kept].tobytes()


def unpack_ids(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    wide, width = np.zeros((n, 4), np.uint8), int(lengths.max(initial=1))
    wide[:, :width][np.arange(width, dtype=np.uint8) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return wide.view("<u4").reshape(-1)


_IDS = "part int, row long, doc_id long, n_tokens long, ids binary"
_BLOCKS = "part int, first_row long, n_ids long, doc_ids binary, lengths binary, control binary, data binary"


def _encoded(path: str, end: int, small: bool):
    """Rows of one range of documents, numbered; ids in two bytes if the vocabulary allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, row = encoder(path, end), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                ids = coder.encode(some.column(1).to_pylist())
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(np.arange(row, row + n, dtype=np.int64)),
                        some.column(0),
                        pa.array(np.array([len(x) for x in ids], np.int64)),
                        pa.array([x.astype("<u2" if small else "<u4").tobytes() for x in ids], pa.binary()),
                    ],
                    names=["part", "row", "doc_id", "n_tokens", "ids"],
                )
                row += n

    return run


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a column one after another, and where each document begins, with the end of the last."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    ids = held[edges[0] : edges[-1]].view(kind)
    return ids, (edges - edges[0]) // ids.itemsize


def _counted(vocabulary: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            ids, _ = _flat(batch.column(0), kind)
            for at in range(0, len(ids), 1 << 20):
                counts += np.bincount(ids[at : at + (1 << 20)], minlength=vocabulary)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])

    return run


def _blocks(ranks, kind: str):
    """Blocks of neighbouring documents of one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of, held, size, last = ranks.value, [], 0, None
        for some in (x for batch in batches for x in batch_parts(batch, 4 << 20)):
            ids, edges = _flat(some.column(3), kind)
            values = rank_of[ids]
            for part, row, doc_id, a, b in zip(*(some.column(k).to_pylist() for k in range(3)), edges[:-1].tolist(), edges[1:].tolist()):
                if held and (size >= BLOCK_IDS or last != (part, row - 1)):
                    yield block(held)
                    held, size = [], 0
                held.append((part, row, doc_id, values[a:b]))
                size, last = size + b - a, (part, row)
        if held:
            yield block(held)

    def block(held: list[tuple]) -> pa.RecordBatch:
        docs = pa.array([h[2] for h in held], pa.int64())
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("doc_id", pa.int64())])) as out:
            out.write_batch(pa.RecordBatch.from_arrays([docs], names=["doc_id"]))
        control, data = pack_ids(np.concatenate([h[3] for h in held]))
        lengths = np.array([len(h[3]) for h in held], "<u4")
        row = [[held[0][0]], [held[0][1]], [int(lengths.sum())], [sink.getvalue().to_pybytes()], [lengths.tobytes()], [control], [data]]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        names = ["part", "first_row", "n_ids", "doc_ids", "lengths", "control", "data"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=names)

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of every text to ``path``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-ids")
    vocabulary = encoder(tokenizer, end).vocabulary
    small = vocabulary <= 1 << 16
    kind = "<u2" if small else "<u4"
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.encode(whole(text), "UTF-8").alias("text"))
    dealt = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ids = scratch.write("ids", dealt.mapInArrow(_encoded(tokenizer, end, small), _IDS))
    with dropping_shuffles(spark):
        counts = ids.select("ids").mapInArrow(_counted(vocabulary, kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(vocabulary, np.int64)
    n[counts.column("id").to_numpy()] = counts.column("n").to_numpy()
    order = np.lexsort((np.arange(vocabulary), -n))
    rank_of = np.empty(vocabulary, np.uint32)
    rank_of[order] = np.arange(vocabulary, dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank_of)
    spark.createDataFrame(pa.table({"rank": np.arange(vocabulary), "id": order})).write.mode("overwrite").parquet(f"{path}/ranks")
    blocks = ids.select("part", "row", "doc_id", "ids").mapInArrow(_blocks(ranks, kind), _BLOCKS)
    blocks.write.mode("overwrite").partitionBy("part").option("compression", "none").parquet(f"{path}/blocks")
    scratch.drop("ids")


def _decoded(id_of):
    names = ["part", "row", "doc_id", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, docs, lengths, control, data in zip(*(batch.column(k).to_pylist() for k in range(6))):
                n = np.frombuffer(lengths, "<u4").astype(np.int64)
                ids = id_of.value[unpack_ids(control, data, int(n.sum()))].astype("<u4")
                edge = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
                docs = pa.ipc.open_stream(docs).read_all().column(0).combine_chunks()
                rows = [ids[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), part, np.int32)), pa.array(first + np.arange(len(n))), docs, pa.array(n), pa.array(rows, pa.binary())], names=names)

    return run


def read_ids(spark: SparkSession, path: str, step=None, schema: str = _IDS) -> DataFrame:
    """part, row, doc_id, n_tokens, ids (little-endian unsigned 32-bit) of every document in the files, or what ``step``, a function
    of such batches, makes of them where they are decoded."""
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").toArrow()
    id_of = spark.sparkContext.broadcast(ranks.column("id").to_numpy().astype(np.uint32))
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    decoded = _decoded(id_of)
    run = decoded if step is None else lambda batches: step(decoded(batches))
    return blocks.select("part", "first_row", "doc_ids", "lengths", "control", "data").mapInArrow(run, schema)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = pa.array([zlib.crc32(ids.as_buffer()) for ids in batch.column(4)], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], crc], names=["part", "row", "doc_id", "n_tokens", "ids_crc32"])


def id_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    rows = read_ids(spark, path, _summed, "part int, row long, doc_id long, n_tokens long, ids_crc32 long")
    parts = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row")) - F.col("n_tokens")
    numbered = rows.withColumn("inside", inside).join(F.broadcast(before), "part")
    return numbered.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
