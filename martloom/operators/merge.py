"""Merges as joins: upsert, insert-or-ignore, touch, child replacement, rejects."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.times import moment

ACTION = "_action"


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    run_ts: datetime | None = None,
    created: str | None = None,
    modified: str | None = None,
    with_action: bool = False,
) -> DataFrame:
    """Rows of the target with the updates merged in. Keys must be unique in both; null keys equal each other.

    A matched row takes ``columns`` from the update and keeps the rest; an unmatched update is inserted.
    ``created`` is stamped on insert only, ``modified`` on both. ``with_action`` adds a column that tells
    insert, update and keep apart, for counting.
    """
    old = target.withColumn("_old", F.lit(True))
    fresh = updates.select(*[F.col(c).alias(f"_u_{c}") for c in updates.columns], F.lit(True).alias("_new"))
    on = [F.col(k).eqNullSafe(F.col(f"_u_{k}")) for k in keys]
    joined = old.join(fresh, on, "full_outer")
    inserted, arrived = F.col("_old").isNull(), F.col("_new").isNotNull()
    stamp = moment(run_ts)

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(c), F.col(f"_u_{c}"))
        if c == created:
            return F.when(inserted, stamp).otherwise(F.col(c))
        if c == modified:
            return F.when(arrived, stamp).otherwise(F.col(c))
        if c in columns:
            return F.when(arrived, F.col(f"_u_{c}")).otherwise(F.col(c))
        if c in updates.columns:
            return F.when(inserted, F.col(f"_u_{c}")).otherwise(F.col(c))
        return F.col(c)

    merged = [value(c).alias(c) for c in target.columns]
    if with_action:
        action = F.when(inserted, "insert").when(arrived, "update").otherwise("keep")
        merged.append(action.alias(ACTION))
    return joined.select(*merged)


def insert_ignore(target: DataFrame, updates: DataFrame, keys: Sequence[str], only_new: bool = False) -> DataFrame:
    """Target plus the updates whose key it lacks; ``only_new`` gives just those, to append.

    Null keys equal each other here: a repeated null key is inserted once. Of several updates with one key
    the lowest by its other columns is kept, so a retried task picks the same one.
    """
    rest = [c for c in updates.columns if c not in keys]
    fresh = updates.select(*keys).distinct()
    if rest:
        lowest = updates.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
        fresh = lowest.select(*keys, "_row.*").select(*updates.columns)
    on = [fresh[k].eqNullSafe(target[k]) for k in keys]
    new = fresh.join(target.select(*keys), on, "left_anti")
    return new if only_new else target.unionByName(new)


def touch(target: DataFrame, rows: DataFrame, key: str, stamp: str, run_ts: datetime) -> DataFrame:
    """Merge by a key that stands for the whole row: known rows get a new stamp, new ones are added.

    With the content fixed by the key, the newest stamp per row is all there is to decide, so this is one
    pre-aggregated shuffle and no join; repeated rows fold into one on the way.
    """
    arrived = rows.withColumn(stamp, moment(run_ts)).select(*target.columns)
    content = [c for c in target.columns if c not in (key, stamp)]
    newest = target.unionByName(arrived).groupBy(key, *content).agg(F.max(stamp).alias(stamp))
    return newest.select(*target.columns)


def replace_children(target: DataFrame, parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Children of the given parents replaced; all others kept. Null keys equal each other.

    The anti join lets adaptive execution split a parent with very many children; a small parent side is
    broadcast by its measured size.
    """
    replaced = parents.select(F.col(key).alias("_replaced")).distinct()
    kept = target.join(replaced, F.col(key).eqNullSafe(F.col("_replaced")), "left_anti")
    return kept.unionByName(children.select(*target.columns))


def split_rejects(df: DataFrame, accepted: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that hold the condition, and those that do not or for which it is unknown."""
    holds = F.coalesce(accepted, F.lit(False))
    return df.where(holds), df.where(~holds)
