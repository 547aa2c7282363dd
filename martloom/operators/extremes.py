"""Daily averages and the days that stand out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Labels of the two ends.
TOP, BOTTOM = "hottest", "coldest"


#: Decimal places that values enter a sum with.
PLACES = 10


def steady_avg(column: str, scale: int = PLACES) -> Column:
    """Average of values summed as decimals, so it does not depend on the order rows arrive in."""
    exact = F.sum(F.col(column).cast(f"decimal(28,{scale})"))
    return exact.cast("double") / F.count(column)


def daily_average(df: DataFrame, day: str, value: str, scale: int = PLACES) -> DataFrame:
    """``year, <day>, avg_value``, pre-aggregated before the shuffle."""
    return df.groupBy(F.year(day).alias("year"), F.col(day)).agg(steady_avg(value, scale).alias("avg_value"))


def extremes(daily: DataFrame, day: str, n: int = 5, average: str = "avg_value") -> DataFrame:
    """The n highest and n lowest days of each year, the earlier day first among equals.

    Both ranks come from one pass over at most 366 rows a year, and a day can be in both lists.
    """
    year = Window.partitionBy("year")
    top = F.row_number().over(year.orderBy(F.col(average).desc_nulls_first(), F.col(day).asc_nulls_last()))
    low = F.row_number().over(year.orderBy(F.col(average).asc_nulls_last(), F.col(day).asc_nulls_last()))
    ranked = daily.withColumns({"_top": top, "_low": low}).where((F.col("_top") <= n) | (F.col("_low") <= n))
    both = F.array(
        F.struct(F.lit(TOP).alias("kind"), F.col("_top").alias("rank_in_kind")),
        F.struct(F.lit(BOTTOM).alias("kind"), F.col("_low").alias("rank_in_kind")),
    )
    rows = ranked.select("year", day, average, F.inline(both))
    return rows.where(F.col("rank_in_kind") <= n)


def in_report_order(df: DataFrame) -> DataFrame:
    """Sorted for reading: by year, kind and rank."""
    return df.orderBy("year", "kind", "rank_in_kind")
