"""Nested records to flat parent and child rows. All row-local: no shuffle but for ``first_of_each``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


POSITION, ITEM = "_pos", "_item"


def items(df: DataFrame, array: str | Column, keep: Sequence[str | Column]) -> DataFrame:
    """One row per array item as ``_pos`` (from 0) and ``_item``; an empty or null array gives none.

    Written as an outer explode with the empty rows dropped after it. For a plain one Spark adds a filter on
    the array's size before the explode, which parses a document two more times when the array comes out of
    ``from_json``.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(POSITION, ITEM)).where(F.col(POSITION).isNotNull())


def flatten(df: DataFrame, array: str | Column, keep: Sequence[str | Column], fields: Mapping[str, str]) -> DataFrame:
    """One row per struct of the array: the kept parent columns, then ``{field: output name}``.

    Meant for arrays stored as such: with a plain explode a Parquet scan reads only the listed fields.
    """
    rows = df.select(*keep, F.explode(array).alias(ITEM))
    kept = [c for c in rows.columns if c != ITEM]
    return rows.select(*kept, *[F.col(ITEM)[f].alias(name) for f, name in fields.items()])


def ordered_items(df: DataFrame, array: str | Column, keep: Sequence[str | Column], order: str, item: str) -> DataFrame:
    """One row per array item with its position, counted from 1."""
    rows = items(df, array, keep)
    kept = [c for c in rows.columns if c not in (POSITION, ITEM)]
    return rows.select(*kept, (F.col(POSITION) + 1).alias(order), F.col(ITEM).alias(item))


def first_of_each(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Of rows with equal keys the one at the lowest position. Pre-aggregates, so a hot key is harmless."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(position)).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)
