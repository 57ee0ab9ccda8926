"""From raw documents to packed training sequences, in stages that each read what the one before has written.

Toxic documents go, of equal texts one document stays, of near duplicates one stays, sources are brought to their target
weights, and what is left is packed. All but the last stage return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablesync.llm.common import Scratch, held_out, table
from tablesync.llm.exact_dedup import keep_owners
from tablesync.llm.mixing import mixed
from tablesync.llm.near_dedup import keep_representatives
from tablesync.llm.packing import Limits, pack
from tablesync.llm.queries import vocabulary
from tablesync.llm.toxicity import fit, keep_clean


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, fit(docs, table(spark, sf_dir, "labels").where(~held_out())))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_owners(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_representatives(docs)


def at_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary(), 2, Limits())


#: Name and function of each stage; a function takes the session, the documents so far and the folder of the tables.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", at_target_weights),
    ("packing", packed),
]

#: SQL can express neither the scores nor the samples nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written and read again, and dropped when the next one is written.

    Run it within `dropping_scratch` to leave nothing behind.
    """
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.write(f"stage-{k}", stage(spark, docs, sf_dir))
        scratch.drop(f"stage-{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
