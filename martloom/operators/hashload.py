"""Loads keyed by a hash of the content: full, first, and incremental with a lookback."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.hashing import row_hash
from martloom.functions.times import lookback_start, moment
from martloom.operators.merge import touch

# Fixed value: how many days before the watermark are read again.
LOOKBACK_DAYS = 3


def hashed(df: DataFrame, columns: Sequence[str], not_null: Sequence[str]) -> DataFrame:
    """Rows with their content hash; rows missing a required value are left out. Equal rows stay."""
    rows = df.select(*columns).dropna(subset=list(not_null))
    return rows.select(row_hash(rows, columns).alias("row_hash"), *columns)


def full_rows(df: DataFrame, columns: Sequence[str], not_null: Sequence[str], run_ts: datetime) -> DataFrame:
    """The whole target, as a full refresh writes it."""
    return hashed(df.select(*columns).distinct(), columns, not_null).withColumn("load_dttm", moment(run_ts))


def window_rows(df: DataFrame, day: str, watermark: date | None, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows an incremental load looks at: from the lookback on, or all when there is no watermark."""
    return df if watermark is None else df.where(F.col(day) >= moment(lookback_start(watermark, days)))


def incremental_rows(
    target: DataFrame,
    df: DataFrame,
    columns: Sequence[str],
    not_null: Sequence[str],
    day: str,
    watermark: date | None,
    run_ts: datetime,
    days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """The target after an incremental load: rows seen again get a new stamp, new ones are added."""
    fresh = hashed(window_rows(df, day, watermark, days), columns, not_null)
    return touch(target, fresh, "row_hash", "load_dttm", run_ts)
