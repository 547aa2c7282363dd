"""Exact percentiles that scale, and trimming by them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The sketch's accuracy, the margin around a fraction in units of the sketch's error, and into how many parts of
# about equal size the values near a percentile are split.
ACCURACY = 10_000
MARGIN = 5 / ACCURACY
PARTS = 200


def percentiles(df: DataFrame, column: str, fractions: Sequence[float]) -> list[float | None]:
    """Percentiles with linear interpolation, nulls ignored, exact; null for a column without values.

    Runs at once, like ``approxQuantile``, and returns one number per fraction. Spark's own exact
    ``percentile`` keeps every distinct value in one task; here three scans of the one column do:

    1. A sketch of fixed size brackets each percentile.
    2. A sketch of the values inside a bracket cuts it into parts of about equal size, however they are spread.
    3. Rows outside the brackets fold into one counter per gap, with its ends; rows inside are counted by value. The
       running total over the parts, a few thousand rows at most whatever the data, tells which parts hold the
       wanted positions, and only those are sorted. A neighbour just outside a bracket is the end of a gap.
    """
    wanted = sorted({float(p) for p in fractions})
    found = percentile_row(df, column, wanted)
    if found is None:
        return [None for _ in fractions]
    row = found.first()
    if any(value is None for value in row):
        raise RuntimeError(f"the sketch of {column} missed a percentile of {wanted}")
    return [row[wanted.index(float(p))] for p in fractions]


def percentile_row(df: DataFrame, column: str, wanted: Sequence[float]) -> DataFrame | None:
    """One row with a column ``p0``, ``p1``, ... for each of the sorted fractions; None without values."""
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    brackets = _brackets(values, wanted)
    if not brackets:
        return None
    return pick(count_cells(values, brackets, edges_inside(values, brackets)), wanted)


def _brackets(values: DataFrame, wanted: Sequence[float]) -> list[tuple[float, float]]:
    """A range of values around each percentile that holds it, or a value next to it."""
    edges = [max(p - MARGIN, 0.0) for p in wanted] + [min(p + MARGIN, 1.0) for p in wanted]
    sketch = values.agg(
        F.percentile_approx("v", edges, ACCURACY).alias("at"), F.min("v").alias("low"), F.max("v").alias("high")
    ).first()
    if sketch.low is None:
        return []
    ends = {0.0: (sketch.low, sketch.low), 1.0: (sketch.high, sketch.high)}
    inner = [
        (sketch.low if p <= MARGIN else sketch["at"][i], sketch.high if p >= 1 - MARGIN else sketch["at"][len(wanted) + i])
        for i, p in enumerate(wanted)
    ]
    return [ends.get(p, bracket) for p, bracket in zip(wanted, inner, strict=True)]


def edges_inside(values: DataFrame, brackets: Sequence[tuple[float, float]]) -> list[list[float]]:
    """Values that cut what lies in each bracket into parts of about equal size."""
    shares = [i / PARTS for i in range(1, PARTS)]
    inside = [F.when((F.col("v") >= lo) & (F.col("v") <= hi), F.col("v")) for lo, hi in brackets]
    row = values.agg(*[F.percentile_approx(v, shares, ACCURACY).alias(f"e{i}") for i, v in enumerate(inside)]).first()
    return [sorted(set(found or [])) for found in row]


def count_cells(values: DataFrame, brackets: Sequence[tuple[float, float]], edges: Sequence[Sequence[float]]) -> DataFrame:
    """``cell, part, v, n, low, high``: the axis cut into cells and parts in value order, with ``v`` only inside brackets.

    Brackets are sorted and may overlap. The number opened plus the number closed before a value numbers the
    cells, and a value lies inside a bracket while more are open than closed.
    """
    v = F.col("v")
    opened = reduce(add, [(v >= lo).cast("int") for lo, _ in brackets])
    closed = reduce(add, [(v > hi).cast("int") for _, hi in brackets])
    part = part_of(v, brackets, edges)
    return (
        values.select((opened + closed).alias("cell"), part.alias("part"), F.when(opened > closed, v).alias("v"), v.alias("any"))
        .groupBy("cell", "part", "v")
        .agg(F.count(F.lit(1)).alias("n"), F.min("any").alias("low"), F.max("any").alias("high"))
    )


def part_of(v: Column, brackets: Sequence[tuple[float, float]], edges: Sequence[Sequence[float]]) -> Column:
    """Number of the part of a bracket that a value lies in; 0 outside."""
    part = F.lit(0)
    for (lo, hi), cuts in zip(brackets, edges, strict=True):
        if cuts:
            passed = F.size(F.filter(F.array(*[F.lit(e) for e in cuts]), lambda e: e <= v))
            # Any split that keeps the order will do; the last bracket that covers a cell decides for it.
            part = F.when((v >= lo) & (v <= hi), passed).otherwise(part)
    return part


def pick(counts: DataFrame, wanted: Sequence[float]) -> DataFrame:
    """One row with the interpolated value at each wanted fraction."""
    everything = Window.orderBy("cell", "part")
    parts = (
        counts.groupBy("cell", "part")
        .agg(F.sum("n").alias("n"))
        .select(
            "cell",
            "part",
            (F.sum("n").over(everything) - F.col("n")).alias("first"),
            F.sum("n").over(everything).alias("next"),
            F.sum("n").over(Window.partitionBy()).alias("total"),
        )
    )
    spots = [F.lit(p) * (F.col("total") - 1) for p in wanted]
    ranks = [rank for spot in spots for rank in (F.floor(spot), F.ceil(spot))]
    holding = parts.where(reduce(Column.__or__, [(F.col("first") <= r) & (r < F.col("next")) for r in ranks]))
    by_value = Window.partitionBy("cell", "part").orderBy("v")
    run = (
        # At most two parts per percentile.
        counts.join(F.broadcast(holding.drop("next")), ["cell", "part"])
        .withColumn("next", F.col("first") + F.sum("n").over(by_value))
        .withColumn("start", F.col("next") - F.col("n"))
    )

    def value_at(rank: Column) -> Column:
        """The value in a bracket, or the end of a gap; null deeper inside a gap, whose values are not known."""
        end = F.when(rank == F.col("start"), F.col("low")).when(rank == F.col("next") - 1, F.col("high"))
        return F.when((F.col("start") <= rank) & (rank < F.col("next")), F.coalesce("v", end))

    at_rank = [F.max(value_at(r)).alias(f"r{i}") for i, r in enumerate(ranks)]
    picked = run.agg(F.max("total").alias("total"), *at_rank)

    def interpolated(i: int) -> Column:
        below, above = F.col(f"r{2 * i}"), F.col(f"r{2 * i + 1}")
        return below + (spots[i] - F.floor(spots[i])) * (above - below)

    return picked.select(*[interpolated(i).alias(f"p{i}") for i in range(len(wanted))])


def trim(df: DataFrame, column: str, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Rows whose value lies between two percentiles of the column, both included; nulls go.

    The bounds are plain numbers in the filter, so they reach the file scan. The frame is read three
    times: write it first if it is costly to compute.
    """
    lowest, highest = percentiles(df, column, [low, high])
    if lowest is None:
        return df.where(F.lit(False))
    return df.where(F.col(column).between(lowest, highest))
