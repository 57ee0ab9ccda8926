"""Mixing sources to target weights by Poisson replication.

A source's target share of the characters divided by its own share is the mean number of copies of each of its documents.
The number of copies is a Poisson number of that mean, read off the distribution function at a uniform number that a
seeded hash of the identifier gives; a mean above ``PART`` is a sum of smaller ones, each with a hash of its own. Copies
are dealt to partitions by hash and sorted by hash, which shuffles the corpus globally. All of it is DataFrame functions;
the same seed gives the same copies on any cluster.

What is joined to the documents is one row for each source, written first and counted; it is broadcast if there are at
most ``MANY``, else adaptive execution splits the hot source's partition. Texts are shuffled once, as copies.

A null source is a source of its own. Null and empty texts count as no characters; a source of only such texts keeps
each document once. Sources without a target weight get none. Null identifiers hash as such; rows with equal identifiers
get equal numbers of copies. An empty table gives an empty result. Columns that the operator adds internally begin with
two underscores; ``copy``, from 1, is added to the columns of the input, and replaces one of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import Scratch, whole

#: Largest mean that is inverted as one, and how many terms of the distribution function that takes.
PART = 16
TERMS = 96
#: Most sources whose rates are broadcast; a source takes less than a kilobyte.
MANY = 20_000


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) of 52 bits of a hash."""
    named = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = 0.5, size: float = 1.0, source: str = "source", text: str = "text") -> DataFrame:
    """__source, rate: mean copies of a document of each source.

    ``weights`` are target weights by source; without them a source's weight is its number of characters to the power of
    ``exponent``. ``size`` is the length of the result in lengths of the input.
    """
    sizes = docs.groupBy(F.col(source).alias("__source")).agg(F.sum(F.char_length(whole(text)).cast("long")).alias("__chars"))
    if weights is None:
        weight = F.sqrt(F.col("__chars").cast("double")) if exponent == 0.5 else F.pow(F.col("__chars").cast("double"), F.lit(exponent))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("__source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    weighed = sizes.withColumn("__weight", F.when(F.col("__chars") > 0, weight).otherwise(F.lit(0.0)))
    total = weighed.agg(F.sum("__weight").alias("__weights"), F.sum("__chars").cast("double").alias("__total"))
    rate = F.col("__weight") / F.col("__weights") * F.col("__total") * F.lit(float(size)) / F.col("__chars").cast("double")
    return weighed.join(F.broadcast(total), how="cross").select("__source", F.when(F.col("__chars") > 0, rate).otherwise(F.lit(1.0)).alias("rate"))


def _terms(mean: Column) -> Column:
    """The distribution function at 0, 1, 2, ..."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("s"), F.array(first).alias("all"))

    def step(so_far: Column, k: Column) -> Column:
        p = so_far["p"] * mean / k
        return F.struct(p.alias("p"), (so_far["s"] + p).alias("s"), F.array_append(so_far["all"], so_far["s"] + p).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda done: done["all"])


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = 0.5, size: float = 1.0, seed: int = 17, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Each document as often as its Poisson number says, in a global random order; ``copy`` numbers the copies."""
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    found = Scratch(docs.sparkSession, "mixing").write("rates", rates(docs, weights, exponent, size, source, text))
    by_source = found.select(
        "__source", parts.alias("__parts"), _terms(F.col("rate") / parts.cast("double")).alias("__terms")
    )
    by_source = F.broadcast(by_source) if found.count() <= MANY else by_source
    found = docs.join(by_source, docs[source].eqNullSafe(by_source["__source"]))
    draws = F.transform(F.sequence(F.lit(1), F.col("__parts")), lambda j: uniform(seed, F.col(doc_id), j))
    copies = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter("__terms", lambda c: c <= u)))
    numbered = found.withColumn("__n", copies).drop("__terms", "__parts", "__source", "copy")
    # outer, as Spark would otherwise compute the number once more to filter by it
    exploded = numbered.withColumn("copy", F.explode_outer(F.when(F.col("__n") > 0, F.sequence(F.lit(1), F.col("__n"))))).where("copy IS NOT NULL").drop("__n")
    key = F.xxhash64(F.lit(seed), F.col(doc_id), F.col("copy"))
    return exploded.withColumn("__key", key).repartition("__key").sortWithinPartitions("__key").drop("__key")
