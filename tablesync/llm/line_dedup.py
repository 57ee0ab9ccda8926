"""Repeated runs of lines, found as content-defined chunks.

A chunk ends after a line when the rolling hash of that line and the one before it falls on a boundary, so the same run of
lines is cut at the same places wherever it stands. A line of ``long_line`` words or more is a chunk of its own. Chunks
of several lines, or of one long line, that occur more than once in the corpus are removed, but for the occurrence of
the smallest identifier (then smallest position). Occurrences are grouped by hash, and a group counts only if all its
texts are equal byte by byte; texts that merely share a hash stay. All of it is DataFrame functions.

A repeated passage is therefore not always removed whole: its first lines up to a boundary and its last ones after one share
their chunk with what is around it, and chunks of one short line, about one in four, always stay. The SQL counterpart has
the same chunks.

All texts are cut once, and the hashes of their chunks written to scratch. Texts that may hold a repeated hash, told by a broadcast
of bounded size, are cut again to compare its chunks, and those that lose chunks a last time.

What is shuffled: hashes of chunks, to count them; the texts of those whose hash repeats, to compare them, which partial
aggregation reduces to one for each task; their places without texts; and the documents once, to take their removed
chunks out. The repeated hashes are broadcast if there are at most ``MANY``.

Null texts stay null and empty ones empty. Blank chunks are never removed. Null identifiers sort last; rows that repeat
identifier and text are one document and all keep or lose the same chunks. A document that only consists of removed
chunks is left with an empty text. An empty table gives an empty result. Columns of the input beside identifier and text
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import Scratch, maybe_among

#: One rolling hash in so many is a boundary.
EVERY = 4
LONG_LINE = 50
#: Most hashes that are broadcast; one takes some 30 bytes.
MANY = 500_000


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def _words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def chunked(docs: DataFrame, text: str = "text", every: int = EVERY, long_line: int = LONG_LINE) -> DataFrame:
    """docs with ``__chunks``, the chunks of the text in order: text, number of lines, words of the first line."""
    lines = docs.withColumn("__lines", F.split(F.col(text), "\n", -1))
    hashed = lines.withColumn("__hash", F.transform("__lines", _line_hash)).withColumn("__long", F.transform("__lines", lambda x: _words(x) >= long_line))
    at = lambda name, k: F.get(F.col(name), k)

    def ends(k: Column) -> Column:
        rolling = F.coalesce(at("__hash", k - 2), F.lit(0)) * 31 + at("__hash", k - 1)
        return (k == F.size("__lines")) | at("__long", k - 1) | at("__long", k) | (rolling % every == 0)

    cut = hashed.withColumn("__ends", F.filter(F.sequence(F.lit(1), F.size("__lines")), ends))

    def chunk(end: Column, k: Column) -> Column:
        before = F.when(k > 0, at("__ends", k - 1)).otherwise(0)
        return F.struct(
            F.array_join(F.slice("__lines", before + 1, end - before), "\n").alias("text"), (end - before).alias("lines"), at("__long", before).alias("long")
        )

    return cut.withColumn("__chunks", F.transform("__ends", chunk)).drop("__lines", "__hash", "__long", "__ends")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = EVERY, long_line: int = LONG_LINE) -> DataFrame:
    """doc_id, text, n_chunks, n_removed, removed_chars of every row."""
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    whole_text = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    kept = kept.withColumn("version", whole_text)
    scratch = Scratch(docs.sparkSession, "line-dedup")

    def counts(c: Column) -> Column:
        return ((c["lines"] > 1) | c["long"]) & (F.translate(c["text"], " \n\t\r", "") != "")

    # all texts are cut once, of which hashes stay; what may repeat is cut again to be compared
    hashes = F.transform("__chunks", lambda c: F.when(counts(c), F.xxhash64(c["text"])))
    cut = scratch.write("cut", chunked(kept, every=every, long_line=long_line).select("doc_id", "version", hashes.alias("hashes")))
    hashed = cut.select("version", F.explode("hashes").alias("hash")).where("hash IS NOT NULL")
    again = scratch.write("again", hashed.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    again = F.broadcast(again) if again.count() <= MANY else again
    concerned = scratch.write("concerned", hashed.join(again, "hash", "left_semi").select("version").distinct())
    keyed = chunked(maybe_among(kept, concerned, "version"), every=every, long_line=long_line)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "at")
    parts = keyed.select("doc_id", "version", F.posexplode_outer("__chunks").alias("at", "chunk"))
    # outer, as Spark would otherwise filter by the size of the array before it has computed it
    parts = parts.where(counts(F.col("chunk"))).select(F.xxhash64("chunk.text").alias("hash"), place.alias("place"), F.col("chunk.text").alias("body"))
    parts = parts.join(again, "hash", "left_semi").select(F.md5(F.col("body").cast("binary")).alias("key"), "place", "body")
    parts = scratch.write("parts", parts)
    groups = parts.groupBy("key").agg(F.min("place").alias("owner"), F.max("place").alias("last"), F.min("body").alias("low"), F.max("body").alias("high"))
    repeated = groups.where("owner <> last AND low = high").select("key", "owner")
    lost = scratch.write("lost", parts.select("key", "place").join(repeated, "key").where("place <> owner").select("place.doc_id", "place.version", "place.at"))
    scratch.drop("again", "concerned", "parts")
    told = cut.select("doc_id", "version", F.size("hashes").alias("n"), F.lit(None).cast("int").alias("at"))
    told = told.unionByName(lost.select("doc_id", "version", F.lit(None).cast("int").alias("n"), "at"))
    told = told.groupBy("doc_id", "version").agg(F.max("n").alias("__n"), F.collect_set("at").alias("__lost"))
    found = kept.join(told.withColumnsRenamed({"doc_id": "__doc", "version": "__version"}), F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("version") == F.col("__version")), "left")
    # after the join, which then moves texts only; those that lose nothing are not cut again
    found = chunked(found.withColumn("__cut", F.when(F.size("__lost") > 0, F.col("text"))), "__cut", every, long_line)
    stays = F.filter("__chunks", lambda c, k: ~F.array_contains("__lost", k))
    cleaned = F.when(F.col("__cut").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stays, lambda c: c["text"]), "\n"))
    return found.withColumn("__clean", cleaned).select(
        "doc_id",
        F.col("__clean").alias("text"),
        F.coalesce("__n", F.lit(0)).cast("long").alias("n_chunks"),
        F.coalesce(F.size("__lost"), F.lit(0)).cast("long").alias("n_removed"),
        (F.char_length(F.coalesce("text", F.lit(""))) - F.char_length(F.coalesce("__clean", F.lit("")))).cast("long").alias("removed_chars"),
    )
