"""Header clean-up and column roles. Works on column names only, never on rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

# Accepted column names per role, first match wins.
ROLE_NAMES = {
    "temperature": ("temp", "temperature", "temp_c", "tempf", "temperature_c", "temperaturef"),
    "date": ("noted_date", "noteddate", "noted_dt", "date", "datetime", "timestamp", "time"),
    "in_out": ("out_in", "out_in_", "outin", "out_in_flag", "in_out", "out_in_status"),
}


def clean_name(raw: str) -> str:
    """Lower-case snake name: ``out/in`` -> ``out_in``, ``1st`` -> ``col_1st``, blank -> ``col_unnamed``."""
    words = re.findall(r"[a-z0-9]+", raw.strip().lower())
    name = "_".join(words) or "col_unnamed"
    return f"col_{name}" if name[0].isdigit() else name


def clean_header(columns: Sequence[str]) -> list[str]:
    """Cleaned names in the given order; two names that clean to the same text are an error."""
    names = [clean_name(c) for c in columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"header names collide after cleaning: {clashes} from {list(columns)}")
    return names


def with_clean_header(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_header(df.columns))


def column_roles(
    columns: Sequence[str], candidates: Mapping[str, Sequence[str]] = ROLE_NAMES
) -> dict[str, str]:
    """Role -> column name, by the ordered candidates; every role must be found."""
    present = set(columns)
    found = {role: next((n for n in names if n in present), None) for role, names in candidates.items()}
    missing = sorted(role for role, name in found.items() if name is None)
    if missing:
        raise ValueError(f"no column for {missing} among {list(columns)}")
    return found


def check_header(actual: Sequence[str], expected: Sequence[str]) -> None:
    """Same columns in the same order once cleaned, else an error that shows both."""
    got, want = clean_header(actual), clean_header(expected)
    if got != want:
        raise ValueError(f"header mismatch: got {got}, expected {want}")
