"""Data rules counted in one pass per table, and the gate that stops a run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named condition that marks a bad row."""

    name: str
    bad: Column


class QualityError(RuntimeError):
    """The checks found errors; nothing after the gate may run."""


def not_null(table: str, *columns: str) -> list[Rule]:
    return [Rule(f"{table}_null_{c}", F.col(c).isNull()) for c in columns]


def one_of(table: str, column: str, values: Sequence[str]) -> Rule:
    """A value outside the list is bad; null is not, as with a table constraint."""
    return Rule(f"{table}_invalid_{column}", ~F.col(column).isin(*values))


def unreadable(table: str, column: str, raw: Column, typed: Column) -> Rule:
    """A text that is there but gave no value: what a tolerant load turned into null."""
    return Rule(f"{table}_unreadable_{column}", raw.isNotNull() & (raw != "") & typed.isNull())


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``check_name, error_count`` for all rules, from a single scan of the table."""
    counted = df.agg(*[F.count_if(r.bad).cast("bigint").alias(r.name) for r in rules])
    return counted.unpivot([], [r.name for r in rules], "check_name", "error_count")


def check_unique(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """How many key values occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return repeated.agg(F.count(F.lit(1)).cast("bigint").alias("error_count")).select(F.lit(name).alias("check_name"), "error_count")


def check_parent(children: DataFrame, parents: DataFrame, name: str, child_key: str, parent_key: str) -> DataFrame:
    """How many child rows point to no parent. A null reference is allowed.

    Children are counted per key before the join, so the join sees each key once.
    """
    referred = children.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    orphans = referred.join(parents.select(F.col(parent_key).alias("_key")), "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("error_count")).select(F.lit(name).alias("check_name"), "error_count")


def all_checks(results: Sequence[DataFrame]) -> DataFrame:
    """Results of several tables as one report, by check name."""
    report = results[0]
    for more in results[1:]:
        report = report.unionByName(more)
    return report.orderBy("check_name")


def gate(report: DataFrame) -> dict[str, int]:
    """Collect the few check counts; any error fails the run, naming the checks."""
    counts = {row.check_name: row.error_count for row in report.collect()}
    total = sum(counts.values())
    if total:
        failed = ", ".join(f"{name}={n}" for name, n in sorted(counts.items()) if n)
        raise QualityError(f"quality checks found {total} errors: {failed}")
    return counts


def check_batch_size(extracted: int, staged: int) -> None:
    """All extracted rows must have arrived in staging."""
    if extracted != staged:
        raise QualityError(f"extracted {extracted} rows but staged {staged}")
