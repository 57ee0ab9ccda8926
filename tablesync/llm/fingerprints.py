"""Threshold-scaled fingerprints of word shingles.

A fingerprint keeps every distinct hash of ``size`` consecutive words that lies in the lowest ``1/keep`` of the range of
hashes, and the smallest hash in any case, so none is empty. It grows with the text, so a short text can be compared
with a very long one, and the fingerprint of texts together is the union of theirs, cut again. The likeness of two is
the estimated containment of the smaller in the larger: what the two share below the threshold, over the smaller of the
counts; where one has nothing there, whether the smallest hashes agree. All of it is DataFrame functions.

Words are runs of letters, digits and marks, in lower case. A text of fewer words is one shingle, also a null or empty
one. Equal texts have equal fingerprints.

``with_next`` puts the text that follows in descending order of identifiers beside each text. Ranges of identifiers,
with bounds that are identifiers of the table, are windows of their own; the first text of a range is also sent to the
range before it, so the whole table needs no common order. Ties are ordered by text, null identifiers come last, and
after the last row comes the first. At most ``RANGES`` bounds reach the driver; beyond ``RANGES * PER_RANGE`` rows
ranges grow, and windows spill.

Columns of the input beside identifier and text are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import whole

SHINGLE = 5
KEEP = 4
PER_RANGE = 1000
RANGES = 20_000
_STEP = 128


def threshold(keep: int) -> int:
    return -(1 << 63) + (1 << 64) // keep


def with_sketch(df: DataFrame, text: str, out: str, size: int = SHINGLE, keep: int = KEEP) -> DataFrame:
    """df with the fingerprint of a column of texts: sorted hashes."""
    words = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}\p{M}]+"), lambda w: w != "")
    hashed = df.withColumn("__words", F.transform(words, lambda w: F.xxhash64(w)))
    starts = F.sequence(F.lit(1), F.greatest(F.size("__words") - size + 1, F.lit(1)))
    shingled = hashed.withColumn("__all", F.transform(starts, lambda k: F.xxhash64(F.slice("__words", k, size))))
    low = F.filter("__all", lambda h: h < threshold(keep))
    kept = F.array_sort(F.array_distinct(F.concat(low, F.array(F.array_min("__all")))))
    return shingled.withColumn(out, kept).drop("__words", "__all")


def likeness(a: str, b: str, keep: int = KEEP) -> Column:
    below = lambda s: F.filter(s, lambda h: h < threshold(keep))
    fewer = F.least(F.size(below(a)), F.size(below(b)))
    shared = F.size(F.filter(F.array_intersect(a, b), lambda h: h < threshold(keep)))
    return F.when(fewer > 0, shared / fewer).otherwise((F.array_min(a) == F.array_min(b)).cast("double"))


def union(a: str, b: str, keep: int = KEEP) -> Column:
    """The fingerprint of two texts together."""
    both = F.array_sort(F.array_union(a, b))
    return F.filter(both, lambda h: (h < threshold(keep)) | (h == F.element_at(both, 1)))


def printed(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(df: DataFrame, doc_id: str, text: str, carried: list[str], per_range: int = PER_RANGE) -> DataFrame:
    """df with ``next_<column>`` of the following row for each of ``carried``."""
    rows = df.select(F.count("*").alias("n"), F.max(doc_id).alias("top")).first()
    parts = max(1, min(RANGES, math.ceil(rows.n / per_range)))
    shares = [k / parts for k in range(1, parts)]
    held = df.select(F.percentile_approx(doc_id, shares, 20 * parts).alias("q")).first().q if shares else []
    bounds = sorted(set(held or []) - {rows.top})
    if bounds:
        coarse, every = F.lit(bounds[_STEP - 1 :: _STEP]) if len(bounds) >= _STEP else F.array().cast("array<bigint>"), F.lit(bounds)
        skipped = F.size(F.filter(coarse, lambda b: b < F.col(doc_id))) * _STEP
        near = F.slice(every, skipped + 1, _STEP)
        below = F.coalesce(skipped + F.size(F.filter(near, lambda b: b < F.col(doc_id))), F.lit(0))
        own = df.withColumn("__range", F.when(F.col(doc_id).isNull(), F.lit(0)).otherwise(below))
        first = F.get(every, F.col("__range")).eqNullSafe(F.col(doc_id)) & F.col(doc_id).isNotNull()
        visits = F.when(first, F.struct((F.col("__range") + 1).alias("range"), F.lit(1).alias("visit")))
    else:
        own, visits = df.withColumn("__range", F.lit(0)), F.lit(None).cast("struct<range:int,visit:int>")
    again = F.when(F.col(doc_id).eqNullSafe(F.lit(rows.top).cast("long")), F.struct(F.lit(0).alias("range"), F.lit(1).alias("visit")))
    places = F.array_compact(F.array(F.struct(F.col("__range").alias("range"), F.lit(0).alias("visit")), visits, again))
    dealt = own.withColumn("__place", F.explode_outer(places)).withColumns({"__range": F.col("__place.range"), "__visit": F.col("__place.visit")}).drop("__place")
    order = Window.partitionBy("__range").orderBy("__visit", F.col(doc_id).desc_nulls_last(), F.col(text).desc())
    following = {f"next_{c}": F.lead(c).over(order) for c in carried}
    return dealt.withColumns(following).where("__visit = 0").drop("__range", "__visit")


def fingerprinted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", per_range: int = PER_RANGE) -> DataFrame:
    """Every text, the text with its last third replaced by the beginning of the following one, and their fingerprints."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    paired = with_next(with_sketch(texts, "text", "sketch"), "doc_id", "text", ["text", "sketch"], per_range)
    third = F.floor(F.col("n_chars") / 3).cast("int")
    counted = paired.withColumn("n_chars", F.char_length("text").cast("long"))
    head = F.substr(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - third)
    edited = counted.withColumn("edited", F.concat(head, F.substr(F.col("next_text"), F.lit(1), third)))
    both = with_sketch(edited, "edited", "edited_sketch")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed("sketch").alias("fingerprint"),
        printed("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"),
        likeness("sketch", "next_sketch").alias("near_next"),
    )
