"""Keyed merge as a DataFrame function.

Plain Parquet tables take no MERGE, so the merged content is computed and published as new files. Target and staged rows meet
in one pass that marks each row as staged or not and matched or not; content and change counts are both read off these marks.

* Staged keys that were measured and fit the broadcast bound are sent to the target, which is then neither shuffled nor sorted.
* Otherwise one full outer join on the key shuffles either side once and gives kept rows, live rows, carried columns and counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.functions.flags import active_condition, delete_condition, is_live
from tablesync.functions.typemap import by_folded_name, typed

MATCHED = "__matched"
STAGED = "__staged"

BROADCAST_BYTES = 128 * 1024 * 1024
_ROW_OVERHEAD = 48  # hash-relation bytes per row beyond the key itself


def broadcast_safe(rows: int, key_bytes: int) -> bool:
    """Whether staged keys, measured while they were written, fit the broadcast bound."""
    return key_bytes + rows * _ROW_OVERHEAD <= BROADCAST_BYTES


@dataclass(frozen=True)
class MergeSpec:
    """How a batch is applied: ordered key columns, and the soft-delete flag if there is one.

    ``broadcast_keys`` is set by callers that have measured the staged keys; otherwise both sides are shuffled once.
    """

    keys: tuple[str, ...]
    delete_flag: str | None = None
    broadcast_keys: bool = False
    #: Staged rows whose key the target holds with a larger value of this column are not applied.
    cursor: str | None = None

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("a merge needs at least one key column")


def align(staged: DataFrame, target: DataFrame) -> DataFrame:
    """Staged columns under the target's spelling and types; columns new to the target stay."""
    have = by_folded_name(target.columns)
    out = []
    for name in staged.columns:
        known = have.get(name.lower())
        if known is None:
            out.append(F.col(f"`{name}`"))
        else:
            value = typed(F.col(f"`{name}`"), staged.schema[name].dataType, target.schema[known].dataType)
            out.append(value.alias(known))
    return staged.select(*out)


def _resolved(spec: MergeSpec, staged: DataFrame) -> MergeSpec:
    """The spec under the spelling the aligned staged columns have."""
    have = by_folded_name(staged.columns)
    flag = spec.delete_flag and have[spec.delete_flag.lower()]
    cursor = spec.cursor and have[spec.cursor.lower()]
    return replace(spec, keys=tuple(have[k.lower()] for k in spec.keys), delete_flag=flag, cursor=cursor)


def without_stale(batch: DataFrame, target: DataFrame, keys: Sequence[str], cursor: str, broadcast_keys: bool = False) -> DataFrame:
    """The batch but for rows whose key the target holds with a larger cursor. Only keys and cursors of the target are read; with
    ``broadcast_keys`` it is not shuffled either."""
    have = by_folded_name(batch.columns)
    names, at = [have[k.lower()] for k in keys], have[cursor.lower()]
    held = target.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{at}`").alias("__held"))
    if broadcast_keys:
        held = F.broadcast(held.join(F.broadcast(batch.select(*names)), names, "left_semi"))
    stale = F.coalesce(F.col("__held") > F.col(f"`{at}`"), F.lit(False))
    return batch.join(held, names, "left").where(~stale).select(*[F.col(f"`{c}`") for c in batch.columns])


def _keys_of(staged: DataFrame, spec: MergeSpec) -> DataFrame:
    keys = staged.select(*spec.keys)
    return F.broadcast(keys) if spec.broadcast_keys else keys


def mark_matches(target: DataFrame, staged: DataFrame, spec: MergeSpec, carry: Sequence[str] = ()) -> DataFrame:
    """Staged rows with whether their key exists in the target and, on request, columns carried over from the target."""
    spec = _resolved(spec, staged)
    keys = list(spec.keys)
    found = target.select(*keys, *carry, F.lit(True).alias(MATCHED))
    if spec.broadcast_keys:
        found = found.join(F.broadcast(staged.select(*keys)), keys, "left_semi")
        if not carry:
            found = F.broadcast(found)  # a subset of the measured keys
    return staged.join(found, keys, "left").withColumn(MATCHED, F.coalesce(MATCHED, F.lit(False)))


def _marked(target: DataFrame, staged: DataFrame, spec: MergeSpec) -> tuple[DataFrame, MergeSpec]:
    aligned = align(staged, target)
    return mark_matches(target, aligned, spec), _resolved(spec, aligned)


def merged_rows(target: DataFrame, staged: DataFrame, spec: MergeSpec) -> DataFrame:
    """Every row of the target and of the batch, once, with its values after the batch and two marks: whether it is staged, and
    whether a staged row's key exists in the target. Flagged rows are still there; `stays` tells what is content.

    ``staged`` is aligned to the target. Columns only the target has keep their value, columns only the batch has
    are added, NULL for rows that stay as they are.
    """
    spec = _resolved(spec, staged)
    target_only = [c for c in target.columns if c not in staged.columns]
    ordered = [*target.columns, *[c for c in staged.columns if c not in target.columns]]
    if spec.broadcast_keys:
        if spec.cursor:
            staged = without_stale(staged, target, spec.keys, spec.cursor, True)
        kept = target.join(F.broadcast(staged.select(*spec.keys)), list(spec.keys), "left_anti")
        kept = kept.withColumns({MATCHED: F.lit(False), STAGED: F.lit(False)})
        batch = mark_matches(target, staged, spec, target_only).withColumn(STAGED, F.lit(True))
        both = kept.unionByName(batch, allowMissingColumns=True)
        return both.select(*[F.col(f"`{c}`") for c in ordered], MATCHED, STAGED)
    old = target.select(*[F.col(f"`{c}`").alias(f"__t{k}") for k, c in enumerate(ordered) if c in target.columns], F.lit(True).alias("__t"))
    new = staged.select(*[F.col(f"`{c}`").alias(f"__s{k}") for k, c in enumerate(ordered) if c in staged.columns], F.lit(True).alias("__s"))
    place = {c: k for k, c in enumerate(ordered)}
    same = [F.col(f"__t{place[k]}") == F.col(f"__s{place[k]}") for k in spec.keys]
    is_staged, values = F.col("__s").isNotNull(), []
    if spec.cursor:
        k = place[spec.cursor]
        is_staged = is_staged & ~F.coalesce(F.col(f"__t{k}") > F.col(f"__s{k}"), F.lit(False))
    for k, c in enumerate(ordered):
        if c not in staged.columns:
            value = F.col(f"__t{k}")
        elif c not in target.columns:
            value = F.when(is_staged, F.col(f"__s{k}"))
        else:
            value = F.when(is_staged, F.col(f"__s{k}")).otherwise(F.col(f"__t{k}"))
        values.append(value.alias(c))
    matched = (is_staged & F.col("__t").isNotNull()).alias(MATCHED)
    return old.join(new, same, "full_outer").select(*values, matched, is_staged.alias(STAGED))


def stays(rows: DataFrame, spec: MergeSpec) -> Column:
    """Which of `merged_rows` are content: all that are not staged, and staged ones that no flag deletes."""
    return ~F.col(STAGED) | is_live(rows, _resolved(spec, rows).delete_flag)


def merge(target: DataFrame, staged: DataFrame, spec: MergeSpec) -> DataFrame:
    """Content of the target after the batch.

    Matched rows take the staged values of all columns the source knows; columns only the target
    has keep their value. Flagged rows are dropped if matched and not inserted if unmatched.
    Columns only the source has are added, NULL for the rows that stay.
    """
    rows = merged_rows(target, align(staged, target), spec)
    return rows.where(stays(rows, spec)).drop(MATCHED, STAGED)


def rows_to_insert(target: DataFrame, staged: DataFrame, spec: MergeSpec) -> DataFrame:
    """Unmatched active rows, as the change counts see them (a NULL flag is not active)."""
    marked, spec = _marked(target, staged, spec)
    return marked.filter(~F.col(MATCHED) & active_condition(marked, spec.delete_flag)).drop(MATCHED)


def rows_to_update(target: DataFrame, staged: DataFrame, spec: MergeSpec) -> DataFrame:
    marked, spec = _marked(target, staged, spec)
    return marked.filter(F.col(MATCHED) & active_condition(marked, spec.delete_flag)).drop(MATCHED)


def rows_to_delete(target: DataFrame, staged: DataFrame, spec: MergeSpec) -> DataFrame:
    marked, spec = _marked(target, staged, spec)
    return marked.filter(F.col(MATCHED) & delete_condition(marked, spec.delete_flag)).drop(MATCHED)


def change_counts(target: DataFrame, staged: DataFrame, spec: MergeSpec) -> DataFrame:
    """One row of recorded change counts, in one pass. A NULL flag counts as neither insert nor
    update, although the merge applies such rows; ``effect_counts`` tells what really happens."""
    marked, spec = _marked(target, staged, spec)
    return marked.agg(*count_columns(marked, spec.delete_flag))


def count_columns(marked: DataFrame, flag: str | None) -> list[Column]:
    """The recorded change counts as aggregates over a marked batch, or over `merged_rows`."""
    active = active_condition(marked, flag)
    if STAGED in marked.columns:
        active = F.col(STAGED) & active
    return [
        F.count_if(~F.col(MATCHED) & active).alias("inserted_row_count"),
        F.count_if(F.col(MATCHED) & active).alias("updated_row_count"),
        F.count_if(F.col(MATCHED) & delete_condition(marked, flag)).alias("deleted_row_count"),
    ]


def effect_counts(target: DataFrame, staged: DataFrame, spec: MergeSpec) -> DataFrame:
    """One row: rows the merge inserts, updates, deletes and ignores (flagged and unmatched)."""
    marked, spec = _marked(target, staged, spec)
    live = is_live(marked, spec.delete_flag)
    return marked.agg(
        F.count_if(~F.col(MATCHED) & live).alias("inserted_rows"),
        F.count_if(F.col(MATCHED) & live).alias("updated_rows"),
        F.count_if(F.col(MATCHED) & ~live).alias("deleted_rows"),
        F.count_if(~F.col(MATCHED) & ~live).alias("ignored_rows"),
    )


def duplicate_keys(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys staged more than once. Counting is partial on the map side, so a hot key is cheap."""
    return staged.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def require_unique(staged: DataFrame, keys: Sequence[str]) -> None:
    """A merge needs at most one staged row per key."""
    found = duplicate_keys(staged, keys).limit(1).collect()
    if found:
        raise ValueError(f"staged rows are not unique on {list(keys)}: {found[0].asDict()}")


def latest_per_merge_key(staged: DataFrame, keys: Sequence[str], cursor: str) -> DataFrame:
    """One row per key: the newest by cursor, NULL cursors last. Ties are broken by a hash of the
    whole row, so a replay picks the same one."""
    plain = [c for c in staged.columns if staged.schema[c].dataType.typeName() != "variant"]
    order = Window.partitionBy(*keys).orderBy(F.col(cursor).desc_nulls_last(), F.xxhash64(*plain))
    return staged.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
