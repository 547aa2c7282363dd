"""Temperature readings: CSV text to a clean layer, yearly extremes, and a target keyed by content."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.hashing import month_slice
from martloom.functions.headers import column_roles
from martloom.functions.numbers import number
from martloom.functions.times import day_first_date
from martloom.operators.extremes import daily_average, extremes
from martloom.operators.hashload import LOOKBACK_DAYS, full_rows, hashed, window_rows
from martloom.operators.merge import touch
from martloom.operators.outliers import trim
from martloom.operators.quality import check, unreadable
from martloom.operators.shape import equals_ignoring_case, with_nulls
from martloom.operators.sliced_percentiles import STATE, sketches, trim_by_slices
from martloom.sinks.runlog import WATERMARKS, RunLog, seed_watermarks
from martloom.sinks.warehouse import Snapshot, Warehouse, append_batch, overwrite, read_or_empty, touched_slices
from martloom.sources.files import csv_text

OPTIONAL = {"device_id": "string", "room_id": "string", "location": "string"}
CLEAN_COLUMNS = ["device_id", "room_id", "location", "outin", "noted_date", "temp_c"]
NOT_NULL = ["noted_date", "temp_c"]
CLEAN = "device_id STRING, room_id STRING, location STRING, outin STRING, noted_date DATE, temp_c DOUBLE"
TARGET = f"row_hash STRING, {CLEAN}, load_dttm TIMESTAMP_NTZ"
PIPELINE = "temperature_target"


def typed_readings(raw: DataFrame, strict: bool = True, optional: dict[str, str] | None = None) -> DataFrame:
    """Indoor readings with date and number typed. ``optional`` maps device, room or location columns.

    Unmapped ones stay null, so equal readings of a day are one and the same row downstream.
    """
    roles = column_roles(raw.columns)
    mapped = {name: column for name, column in (optional or {}).items() if name in OPTIONAL}
    rows = raw.where(equals_ignoring_case(F.col(roles["in_out"]), "in")).select(
        *[F.col(column).alias(name) for name, column in mapped.items()],
        F.col(roles["in_out"]).alias("outin"),
        day_first_date(F.col(roles["date"]), strict).alias("noted_date"),
        number(F.col(roles["temperature"]), "double", strict).alias("temp_c"),
    )
    return with_nulls(rows, OPTIONAL).select(*CLEAN_COLUMNS)


def reading_rejects(raw: DataFrame) -> DataFrame:
    """How many dates and numbers of indoor rows a tolerant load cannot read, from one scan."""
    roles = column_roles(raw.columns)
    day, value = F.col(roles["date"]), F.col(roles["temperature"])
    rules = [
        unreadable("readings", "noted_date", day, day_first_date(day, strict=False)),
        unreadable("readings", "temp_c", value, number(value, "double", strict=False)),
    ]
    return check(raw.where(equals_ignoring_case(F.col(roles["in_out"]), "in")), rules)


def clean_layer(typed: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Readings between the two percentiles. Rows without a date take part in the percentiles, then go."""
    return trim(typed, "temp_c", low, high).where(F.col("noted_date").isNotNull())


def yearly_extremes(clean: DataFrame, n: int = 5) -> DataFrame:
    daily = daily_average(clean, "noted_date", "temp_c").withColumnRenamed("avg_value", "avg_temp_c")
    return extremes(daily, "noted_date", n, "avg_temp_c")


def build_clean(spark: SparkSession, source: str | list[str], root: str, strict: bool = True, optional: dict[str, str] | None = None) -> None:
    """CSV -> staging as text -> typed -> clean. Typed rows are written, as the trim reads them several times.

    A tolerant load also writes how many texts it could not read to ``rejects``.
    """
    overwrite(csv_text(spark, source, strict=strict), f"{root}/staging")
    raw = spark.read.parquet(f"{root}/staging")
    if not strict:
        overwrite(reading_rejects(raw), f"{root}/rejects")
    typed = typed_readings(raw, strict, optional)
    overwrite(typed, f"{root}/typed")
    overwrite(clean_layer(read_or_empty(spark, f"{root}/typed", CLEAN)), f"{root}/clean")


def add_readings(spark: SparkSession, typed: DataFrame, root: str, batch_id: str) -> None:
    """Add one batch of typed rows to the layer, and its sketches by month; nothing that was there before is read.

    A batch counts once its sketches are there. Adding it again replaces it.
    """
    batch = F.lit(batch_id).alias("batch_id")
    append_batch(typed.select(*CLEAN_COLUMNS, batch), f"{root}/typed_batches")
    written = spark.read.schema(f"{CLEAN}, batch_id STRING").parquet(f"{root}/typed_batches").where(F.col("batch_id") == batch_id)
    append_batch(sketches(written, "temp_c", F.date_format("noted_date", "yyyy-MM")).select("*", batch), f"{root}/sketches")


def grown_clean_layer(spark: SparkSession, root: str, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """The clean layer over all batches so far. The percentiles come from the sketches and one pruned scan."""
    state = read_or_empty(spark, f"{root}/sketches", f"{STATE}, batch_id STRING", "batch_id")
    typed = read_or_empty(spark, f"{root}/typed_batches", f"{CLEAN}, batch_id STRING", "batch_id")
    typed = typed.join(state.select("batch_id").distinct(), "batch_id", "left_semi").select(*CLEAN_COLUMNS)
    return trim_by_slices(typed, "temp_c", state, low, high).where(F.col("noted_date").isNotNull())


def build_extremes(spark: SparkSession, root: str, n: int = 5) -> None:
    clean = read_or_empty(spark, f"{root}/clean", CLEAN)
    overwrite(yearly_extremes(clean, n), f"{root}/extremes")


def newest_date(now: Snapshot) -> date | None:
    """The target's newest date. Slices are months, so it lies in the last one that a full load has not emptied."""
    for month in reversed(now.slices("target")):
        newest = now.read("target", "noted_date DATE", [month]).agg(F.max("noted_date")).first()[0]
        if newest is not None:
            return newest
    return None


def load_target(
    wh: Warehouse, clean: DataFrame, mode: str, run_ts: datetime, lookback_days: int = LOOKBACK_DAYS
) -> date | None:
    """Load the target in exactly one mode, ``full`` or ``incremental``; returns the new watermark.

    The hash covers the date, so a row can only match within its month: an incremental load rewrites
    the months its window touches and leaves the rest alone.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"load mode {mode!r} is neither full nor incremental")
    stored = seed_watermarks(wh, {PIPELINE: "noted_date"})[PIPELINE]
    watermark = stored.date() if stored is not None else None
    slice_of = month_slice("noted_date")
    log = RunLog(wh)
    now = wh.snapshot()
    version = f"{run_ts.strftime('%Y%m%dT%H%M%S')}-{now.next_seq}"
    try:
        with log.step(f"target_{mode}", PIPELINE) as counts:
            if mode == "full":
                rows = full_rows(clean, CLEAN_COLUMNS, NOT_NULL, run_ts)
                kept = now.slices("target")
            else:
                fresh = hashed(window_rows(clean, "noted_date", watermark, lookback_days), CLEAN_COLUMNS, NOT_NULL)
                kept = touched_slices(fresh, slice_of)
                rows = touch(now.read("target", TARGET, kept), fresh, "row_hash", "load_dttm", run_ts)
            wh.write_version(rows, "target", version, slice_of)
            written = wh.written_slices("target", version)
            # A full load also empties the months that no longer occur.
            wh.commit(now.next_seq, version, ["target"], {*kept, *written}, run_ts)
            counts["inserted"] = wh.read_version("target", version, TARGET).count()
        with log.step("watermark", PIPELINE):
            newest = newest_date(wh.snapshot())
            at = None if newest is None else datetime(newest.year, newest.month, newest.day)
            wh.append_log("watermarks", [(PIPELINE, "noted_date", at, run_ts, "success")], WATERMARKS)
    finally:
        log.flush()
    return newest
