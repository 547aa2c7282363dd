"""Columns every load adds: defaults, typed nulls, labels, provenance."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Add each column the frame does not have, holding its default."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def with_nulls(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add each column the frame does not have, empty but typed."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


def equals_ignoring_case(column: Column, value: str) -> Column:
    return F.lower(column) == value.lower()


def required(column: Column, name: str) -> Column:
    """The column, or a failed job where it is null."""
    return F.when(column.isNull(), F.raise_error(F.lit(f"{name} is required but null"))).otherwise(column)
