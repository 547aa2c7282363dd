"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import workspace

#: The characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
ROW = "_row"


def whole(df: DataFrame, *more: Column) -> DataFrame:
    """All columns of a frame as one struct, so that no column added beside it can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), *more)


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"{ROW}.`{c}`") for c in columns])


def settled(*columns: Column) -> Column:
    """Columns that are computed once and as they stand: a filter on one is not merged into what it is made of.

    They come out of a generator, below which Spark moves no filter. Without it, a filter would take the expression
    of an array into the functions that run over its items, and compute it anew for each.
    """
    return F.inline(F.array(F.struct(*columns)))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of one action."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet to the shared folder and read back.

    The written table cuts the lineage: a lost executor costs the tasks it ran, not the steps before them. So the
    shuffle files of those steps, which nothing reads any more, are given up when the table is written.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text in order: runs of characters other than the six ASCII spaces; of null, none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
