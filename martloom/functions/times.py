"""Dates, durations and windows of time."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day first, with or without leading zeros.
DAY_FIRST = "d-M-yyyy H:m"


def moment(value: date | datetime | None) -> Column:
    """A constant date or zone-less timestamp.

    A timestamp goes through its text: a plain literal would be an instant, read in the time zone of the
    driver's machine, and comparing a zone-less column with an instant is not pushed to the file scan.
    """
    if isinstance(value, datetime) or value is None:
        return F.lit(None if value is None else value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def day_first_date(text: Column, strict: bool = True) -> Column:
    """``08-12-2018 09:30`` or ``8-12-2018 9:30`` to 8 December 2018."""
    return F.to_date(text, DAY_FIRST) if strict else F.try_to_date(text, DAY_FIRST)


def elapsed(start: Column, end: Column) -> Column:
    """Seconds from start to end with microseconds, exact, and free of the session time zone."""
    return (end - start).cast("interval second").cast("decimal(20,6)")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds, halves rounded away from zero."""
    return F.round(elapsed(start, end), 0).cast("int")


def elapsed_hours(start: Column, end: Column) -> Column:
    return F.round(elapsed(start, end) / F.lit(3600), 2).cast("decimal(12,2)")


def lookback_start(watermark: date | datetime, days: int) -> date | datetime:
    """Start of the re-read window. A plain value, so the filter prunes partitions."""
    return watermark - timedelta(days=days)
