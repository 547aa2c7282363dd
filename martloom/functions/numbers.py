"""Text to numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: everything but these characters is removed before a number is read.
NOT_NUMERIC = "[^0-9.,]+"


def digits_only(text: Column) -> Column:
    """Keep digits, dots and commas; nothing left means null. A minus sign is lost too."""
    return F.nullif(F.regexp_replace(text, NOT_NUMERIC, ""), F.lit(""))


def amount(text: Column, strict: bool = True, sql_type: str = "decimal(10,2)") -> Column:
    """Number inside a text. Strict raises on what is left over (``4,5``); otherwise it gives null."""
    digits = digits_only(text)
    return digits.cast(sql_type) if strict else digits.try_cast(sql_type)


def number(text: Column, sql_type: str = "double", strict: bool = True) -> Column:
    """An empty text is null; anything else must read as the type, or give null when not strict."""
    cleaned = F.nullif(text, F.lit(""))
    return cleaned.cast(sql_type) if strict else cleaned.try_cast(sql_type)
