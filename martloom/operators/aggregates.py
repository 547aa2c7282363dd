"""Group summaries: modes, profiles, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mode_rank(value: str, count: Column) -> Column:
    """Order that puts the most frequent value first, then the lower value, null last."""
    return F.struct((-count).alias("n"), F.col(value).isNull().alias("none"), F.col(value).alias("v"))


def mode(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The most frequent value of each group; equal counts go to the lower value, null last.

    Counting by (group, value) first takes the load off a hot group before it meets in one place.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*keys).agg(F.min_by(value, mode_rank(value, F.col("_n"))).alias(name))


def profile(df: DataFrame, column: str) -> DataFrame:
    """Row count, smallest and largest value of a layer."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(column).alias(f"min_{column}"),
        F.max(column).alias(f"max_{column}"),
    )


def distribution(df: DataFrame, column: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def rounded_avg(column: str | Column, scale: int = 2) -> Column:
    """Average of whole numbers or cents as ``decimal(12,scale)``, null for no values.

    The decimal types leave the quotient 15 digits after the point before it is rounded.
    """
    total = F.sum(F.col(column) if isinstance(column, str) else column).cast("decimal(24,2)")
    n = F.count(column).cast("decimal(12,0)")
    return F.round(F.when(n > 0, total / n), scale).cast(f"decimal(12,{scale})")


def sum_or_zero(column: str | Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))
