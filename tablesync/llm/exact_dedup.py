"""Exact duplicates by Patricia tries.

Texts are equal when nothing differs but white space (space and the controls 9 to 13). Each task first puts its own
texts into a trie, so that a text it holds a thousand times leaves it once; what is left is dealt by length and content
hash, and a second trie per partition, holding whole byte strings, finds the owner of each. Both are bounded: the first
empties itself when it is full, the second spills subtrees.

Null texts count as empty, and so equal each other and texts of white space alone. Ties are broken by identifier, null
identifiers last. Where an identifier repeats, the rows with most code points stay; rows that repeat identifier and length too
are one document: all carry the same owner and the same ``kept``. An empty table gives an empty result. Columns of the input beside identifier and text are not looked at, so
no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import Scratch, whole
from tablesync.llm.trie import Trie

WHITE = " \t\n\x0b\x0c\r"
TRIE_BYTES = 192 << 20
_PART = pa.schema([("body", pa.binary()), ("most", pa.int64()), ("owner", pa.int64()), ("rows", pa.int64()), ("same", pa.int64())])
_GROUP = pa.schema([("sha", pa.string()), ("most", pa.int64()), ("owner", pa.int64()), ("rows", pa.int64()), ("same", pa.int64())])
_GROUPS = "sha string, most long, owner long, rows long, same long"
#: Marks of repeated hashes that are broadcast: their number bounds the broadcast, whatever the corpus.
MARKS = 1 << 20


def normalised(text: str) -> Column:
    return F.translate(whole(text), WHITE, "")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)))


def _combined(budget: int):
    """Owners among the texts of one task; the trie empties itself whenever full, as a later one joins the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(budget << 2)
        for body, most, owner in _rows(batches):
            trie.insert(body, (most, owner, 1, 1))
            if trie.size > budget:
                yield from drained(trie)
                trie = Trie(budget << 2)
        yield from drained(trie)

    def drained(trie: Trie) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for body, owner in trie.strings():
            held.append((body, *owner))
            size += len(body)
            if size > 16 << 20:
                yield _batch(held, _PART)
                held, size = [], 0
        if held:
            yield _batch(held, _PART)

    return run


def _owners(budget: int):
    """Owner and rows of every text that more than one row has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(budget)
        for body, *owner in _rows(batches):
            trie.insert(body, tuple(owner))
        found = [(sha, *o) for sha, o in trie.digests() if o[2] > 1]
        if found:
            yield _batch(found, _GROUP)

    return run


def repeated_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = TRIE_BYTES) -> DataFrame:
    """sha, most (code points of the owner's text), owner, rows, same (rows with the owner's identifier and length) of every text
    that more than one row has."""
    body = F.encode(normalised(text), "UTF-8").alias("body")
    texts = docs.select(body, F.char_length(whole(text)).cast("long").alias("most"), F.col(doc_id).cast("long").alias("owner"))
    parts = texts.mapInArrow(_combined(budget // 4), "body binary, most long, owner long, rows long, same long")
    dealt = parts.repartition(F.octet_length("body"), F.xxhash64("body"))
    return dealt.mapInArrow(_owners(budget), _GROUPS)


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = TRIE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    groups = repeated_texts(docs, doc_id, text, budget)
    n = F.char_length(whole(text)).cast("long").alias("n")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.sha2(normalised(text), 256).alias("text_sha256"), n)
    found = rows.join(groups, rows.text_sha256 == groups.sha, "left")
    keep = F.when(F.col("sha").isNull(), F.col("doc_id")).otherwise(F.col("owner"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
        (keep.eqNullSafe(F.col("doc_id")) & F.coalesce(F.col("n") == F.col("most"), F.lit(True))).alias("kept"),
        "text_sha256",
    )


def keep_owners(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = TRIE_BYTES) -> DataFrame:
    """The rows of docs, all columns, that own their text; of rows that repeat identifier and length, the least text stays, once.

    Only rows whose hash may be repeated meet the repeated hashes in a join; the others are told by a broadcast of at most ``MARKS``
    numbers and are not shuffled.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    groups = scratch.write("groups", repeated_texts(docs, doc_id, text, budget)).withColumnRenamed("sha", "key")
    mark = F.pmod(F.xxhash64("key"), F.lit(MARKS))
    marks = F.broadcast(groups.select(mark.alias("mark")).distinct().withColumn("repeated", F.lit(True)))
    row, known = F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.sha2(normalised(text), 256)
    rows = docs.select(row.alias("row"), known.alias("key"), F.char_length(whole(text)).alias("n"), F.col(f"`{doc_id}`").cast("long").alias("id"), whole(text).alias("body"))
    told = rows.withColumn("mark", mark).join(marks, "mark", "left")
    alone = told.where("repeated IS NULL").select("row")
    found = told.where("repeated").drop("mark", "repeated").join(groups, "key", "left")
    kept = found.where(F.col("owner").isNull() & F.col("most").isNull() | F.col("id").eqNullSafe(F.col("owner")) & (F.col("n") == F.col("most")))
    if not groups.where("same > 1").isEmpty():
        first = F.row_number().over(Window.partitionBy("key").orderBy("body"))
        once = kept.where("same > 1").withColumn("place", first).where("place = 1")
        kept = kept.where("same IS NULL OR same = 1").unionByName(once.drop("place"))
    return alone.unionByName(kept.select("row")).select(*(F.col(f"row.`{c}`") for c in docs.columns))
