"""Connected components of links, as tables on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import Scratch


def components(nodes: DataFrame, links: DataFrame, scratch: Scratch, name: str, start: DataFrame | None = None) -> DataFrame:
    """id, label of every node: the smallest identifier it is linked with, directly or not.

    Each round gives the roots new names, those of smaller roots they are linked with, and writes the edges between roots
    that still differ. The number of rounds grows with the logarithm of the longest chain of links. ``start`` gives labels of an earlier run, which are kept where no new link
    joins them.
    """
    labels = scratch.write(f"{name}-0", start.select("id", "label") if start is not None else nodes.select("id", F.col("id").alias("label")))
    named = lambda c: labels.select(F.col("id").alias(c), F.col("label").alias(f"label_{c}"))
    edges = scratch.write(f"{name}-edges-0", _between(links.join(named("a"), "a").join(named("b"), "b")))
    round_ = 0
    while not edges.isEmpty():
        round_ += 1
        # a root hooks onto its smallest neighbour if that is smaller, so there are no cycles, and then onto where that goes
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("to")).where("to < a")
        hooks = scratch.write(f"{name}-hooks-{round_}", hooks)
        once = hooks.select(F.col("a").alias("to"), F.col("to").alias("then"))
        short = hooks.join(once, "to", "left").select("a", F.coalesce("then", "to").alias("to"))
        moved = short.select(F.col("a").alias("label"), F.col("to").alias("root"))
        labels = scratch.write(f"{name}-{round_}", labels.join(moved, "label", "left").select("id", F.coalesce("root", "label").alias("label")))
        ends = lambda c: moved.select(F.col("label").alias(c), F.col("root").alias(f"label_{c}"))
        renamed = edges.join(ends("a"), "a", "left").join(ends("b"), "b", "left")
        shifted = renamed.select(F.coalesce("label_a", "a").alias("label_a"), F.coalesce("label_b", "b").alias("label_b"))
        edges = scratch.write(f"{name}-edges-{round_}", _between(shifted))
        scratch.drop(f"{name}-{round_ - 1}", f"{name}-edges-{round_ - 1}", f"{name}-hooks-{round_}")
    return labels


def _between(pairs: DataFrame) -> DataFrame:
    """Edges between different roots, each once, the smaller first."""
    return pairs.where("label_a <> label_b").select(F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b")).distinct()
