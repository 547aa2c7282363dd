"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"


def newest_first(time: str, *ties: str) -> list[Column]:
    """Time descending where a null time counts as newest, then the tie-breaks descending."""
    return [F.col(time).desc_nulls_first(), *[F.col(c).desc_nulls_first() for c in ties]]


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by a total order.

    Spark cuts each map task down to one row per key before the shuffle, so a key that holds a large
    share of all rows costs no more than any other.
    """
    ranked = df.withColumn(RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(RANK) == 1).drop(RANK)


def fold_latest(known: DataFrame, arrived: DataFrame, key: str, time: str, ties: Sequence[str], changed: str) -> DataFrame:
    """Known winners and arrived rows folded into the new winners, in one pre-aggregated shuffle.

    ``changed`` marks the keys for which anything arrived, whichever row won.
    """
    columns = [c for c in known.columns if c != changed]
    both = known.withColumn(changed, F.lit(False)).unionByName(arrived.withColumn(changed, F.lit(True)), allowMissingColumns=True)
    # A null time must win, and a bare null sorts lowest: hence the flag in front.
    rank = F.struct(F.col(time).isNull().alias("open"), time, *ties)
    payload = F.struct(*[c for c in columns if c != key])
    folded = both.groupBy(key).agg(F.max_by(payload, rank).alias("_row"), F.max(changed).alias(changed))
    return folded.select(key, "_row.*", changed)


def latest_payload(landed: DataFrame, source: str, file_type: str) -> DataFrame:
    """The payload of a source that was landed last; equal times are settled by id.

    Time and id are looked up first, from their own columns. They then filter the scan that reads payloads,
    so files and row groups of other times are skipped.
    """
    rows = landed.where((F.col("file_type") == file_type) & (F.col("source") == source))
    order = F.struct(F.col("loaded_at").isNull().alias("open"), "loaded_at", "raw_id")
    newest = rows.agg(F.max(order).alias("newest"))
    at, raw_id = (newest.select(f"newest.{c}").scalar() for c in ("loaded_at", "raw_id"))
    return rows.where(F.col("loaded_at").eqNullSafe(at) & (F.col("raw_id") == raw_id)).limit(1)


def latest_payloads(landed: DataFrame) -> DataFrame:
    """The payload landed last, for every source. Only its id is looked up first, so no payload is sorted."""
    rank = F.struct(F.col("loaded_at").isNull().alias("open"), "loaded_at", "raw_id")
    newest = landed.groupBy("source", "file_type").agg(F.max(rank).alias("_newest"))
    keys = newest.select(F.col("source").alias("_source"), F.col("file_type").alias("_type"), "_newest.loaded_at", "_newest.raw_id")
    keys = keys.withColumnsRenamed({"loaded_at": "_at", "raw_id": "_id"})
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("source", "_source"), ("file_type", "_type"), ("loaded_at", "_at"), ("raw_id", "_id"))]
    return landed.join(keys, same, "left_semi")
