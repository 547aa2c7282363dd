"""Exact percentiles of a layer that grows slice by slice: a mergeable sketch each, exact counts near the percentiles.

A slice is sketched once, from one scan of the column. Slices that come later leave the sketches of earlier ones alone,
and asking for percentiles merges the sketches and reads only the values that lie outside the widest gap between
the wanted percentiles, one pruned scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from martloom.operators.outliers import count_cells, edges_inside, part_of, pick

STATE = "slice STRING, n BIGINT, numbers BIGINT, low DOUBLE, high DOUBLE, sketch BINARY"
#: Size of a sketch: its ranks are off by 0.14 percent of the rows, and so are those of many merged.
K = 2048
#: How far around a percentile rows are counted one by one. Wider ranges are tried if one should miss.
MARGIN = 0.01


def sketches(df: DataFrame, column: str, slice_of: Column) -> DataFrame:
    """One row per slice: number of values, ends, and a sketch of the numbers. Nulls are ignored; NaN is the greatest value.

    Rows of the same slice may be added up from several frames, so a batch needs no look at what is there. A slice
    without values has no row.
    """
    values = df.select(slice_of.cast("string").alias("slice"), F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    return values.groupBy("slice").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.isnan("v")).alias("numbers"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.kll_sketch_agg_double("v", F.lit(K)).alias("sketch"),
    )


def percentiles_of_slices(df: DataFrame, column: str, state: DataFrame, fractions: Sequence[float]) -> list[float | None]:
    """What ``outliers.percentiles`` gives for the rows, with the sketches of all their slices at hand; runs at once.

    Fails if the sketches are not those of the rows, as far as the rows that are read can tell.
    """
    wanted = sorted({float(p) for p in fractions})
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    whole = state.agg(*[F.sum(c).alias(c) for c in ("n", "numbers")], F.min("low").alias("low"), F.max("high").alias("high")).first()
    if not whole.n:
        return [None for _ in fractions]
    margin = MARGIN
    while True:
        row = _counted(values, whole, _brackets(state, whole, wanted, margin), wanted)
        if all(value is not None for value in row):
            return [row[wanted.index(float(p))] for p in fractions]
        if margin > 1:
            raise RuntimeError(f"the sketches of {column} are not those of its rows")
        margin *= 4


def trim_by_slices(df: DataFrame, column: str, state: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Rows whose value lies between two percentiles, both included; nulls go. See ``outliers.trim``."""
    lowest, highest = percentiles_of_slices(df, column, state, [low, high])
    if lowest is None:
        return df.where(F.lit(False))
    return df.where(F.col(column).between(lowest, highest))


def _brackets(state: DataFrame, whole: Row, wanted: Sequence[float], margin: float) -> list[tuple[float, float]]:
    """A range of values around each percentile: a margin of ranks and one row to both sides, by the merged sketch.

    The sketch leaves NaN out, which lies above the share of numbers.
    """
    off = margin * whole.n + 1
    spots = [p * whole.n + side * off for p in wanted for side in (-1, 1)]
    ranks = [min(max(spot / max(whole.numbers, 1), 0.0), 1.0) for spot in spots]
    merged = state.where("numbers > 0").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    at = merged.select(F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(r) for r in ranks]))).first()[0] if whole.numbers else []
    found = []
    for i, p in enumerate(wanted):
        below = whole.low if spots[2 * i] <= 0 or not at else at[2 * i]
        above = whole.high if spots[2 * i + 1] >= whole.numbers else at[2 * i + 1]
        found.append({0.0: (whole.low, whole.low), 1.0: (whole.high, whole.high)}.get(p, (below, above)))
    return found


def _counted(values: DataFrame, whole: Row, brackets: Sequence[tuple[float, float]], wanted: Sequence[float]) -> Row:
    """The percentiles, null where a range missed one. The rows of the widest gap are not read but are what is left of all."""
    ends = [0.0, *wanted, 1.0]
    clear = [g for g in range(1, len(brackets)) if brackets[g - 1][1] < brackets[g][0]]
    gap = max([0, *clear, len(brackets)], key=lambda g: ends[g + 1] - ends[g])
    sides = [F.col("v") <= hi for _, hi in brackets[gap - 1 : gap]] + [F.col("v") >= lo for lo, _ in brackets[gap : gap + 1]]
    read = values.where(sides[0] if len(sides) == 1 else sides[0] | sides[1])
    counts = count_cells(read, brackets, [[] for _ in brackets]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        left = whole.n - (counts.agg(F.sum("n")).first()[0] or 0)
        if left < 0:
            raise RuntimeError("there are more rows than the sketches have seen")
        nothing = F.lit(None).cast("double")
        rest = values.sparkSession.range(min(left, 1)).select(
            F.lit(2 * gap).alias("cell"), F.lit(0).alias("part"), nothing.alias("v"), F.lit(left).alias("n"), nothing.alias("low"), nothing.alias("high")
        )
        # Values of a range are cut into parts of about equal numbers of distinct ones, so that no task sorts them all.
        parts = part_of(F.col("v"), brackets, edges_inside(counts, brackets))
        return pick(counts.withColumn("part", parts).unionByName(rest), wanted).first()
    finally:
        counts.unpersist()
