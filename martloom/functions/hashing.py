"""Stable ids and content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: separator between the column texts that are hashed.
SEPARATOR = "|"


def hash_text(df: DataFrame, column: str) -> Column:
    """Text of a column as it enters the hash: null is empty and 31.0 reads 31."""
    text = F.col(column).cast("string")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        text = F.regexp_replace(text, r"\.0$", "")
    return F.coalesce(text, F.lit(""))


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """md5 over all given columns, in order."""
    return F.md5(F.concat_ws(SEPARATOR, *[hash_text(df, c) for c in columns]))


def surrogate_id(*parts: str | Column) -> Column:
    """A generated id of 128 bits that comes out the same on every retry and re-run.

    Each part enters with its length in front, and a null as a sign of its own, so no two lists of parts read alike.
    """
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def hash_slice(key: str | Column, slices: int) -> Column:
    """The slice, 0 to slices-1, that stores this key."""
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")


def month_slice(day: str | Column) -> Column:
    """The slice, as yyyymm, that stores this date."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def message_id() -> Column:
    """Topic, partition and offset: unique per message and the same on replay."""
    return F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
