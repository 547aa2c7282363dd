"""Percentile trimming, extremes, content hashes, watermarks."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.extremes import daily_average, extremes, in_report_order
from martloom.operators.hashload import full_rows, incremental_rows
from martloom.operators.outliers import percentile_row, trim
from martloom.plans import temperature
from martloom.queries import inputs
from martloom.queries.registry import query, table
from martloom.session import workspace
from martloom.sinks.runlog import advance_watermark, seed_watermarks, watermarks
from martloom.sinks.warehouse import Warehouse
from martloom.sources.documents import since

FIRST_RUN, SECOND_RUN = datetime(2024, 1, 21, 6, 0), datetime(2024, 2, 1, 6, 0)


#: Slices of the queries' warehouses: a few GB each at full size, however small the tables at hand.
SLICES = 4


@query(
    "outlier_trim",
    """
    SELECT event_id, value FROM events
    WHERE value >= (SELECT quantile_cont(value, 0.05) FROM events) AND value <= (SELECT quantile_cont(value, 0.95) FROM events)
    """,
)
def outlier_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim(table(spark, sf_dir, "events").select("event_id", "value"), "value")


@query(
    "percentile_bounds",
    """
    SELECT round(quantile_cont(l_extendedprice, 0.05), 6) AS p05, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
           round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, max(l_extendedprice) AS p100 FROM lineitem
    """,
)
def percentile_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = percentile_row(table(spark, sf_dir, "lineitem"), "l_extendedprice", [0.05, 0.5, 0.95, 1.0])
    return found.select(*[F.round(f"p{i}", 6).alias(name) for i, name in enumerate(["p05", "p50", "p95", "p100"])])


@query(
    "daily_extremes",
    """
    WITH means AS (
      SELECT CAST(o_orderdate AS DATE) AS d, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS a
      FROM orders GROUP BY CAST(o_orderdate AS DATE))
    SELECT y AS year, unnest(days).d AS noted_date, round(unnest(days).a, 4) AS avg_value, kind,
           CAST(generate_subscripts(days, 1) AS INTEGER) AS rank_in_kind
    FROM (
      SELECT CAST(year(d) AS INTEGER) AS y, 'hottest' AS kind, list({'d': d, 'a': a} ORDER BY a DESC, d)[1:5] AS days FROM means GROUP BY 1
      UNION ALL
      SELECT CAST(year(d) AS INTEGER), 'coldest', list({'d': d, 'a': a} ORDER BY a, d)[1:5] FROM means GROUP BY 1)
    """,
)
def daily_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("noted_date"), "o_totalprice")
    found = extremes(daily_average(orders, "noted_date", "o_totalprice", scale=2), "noted_date")
    return in_report_order(found.withColumn("avg_value", F.round("avg_value", 4)))


READING_HASH = """
md5(event_type || '|||in|' || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '|' || regexp_replace(CAST(value AS VARCHAR), '\\.0$', ''))
"""
READING_ROWS = f"""
SELECT DISTINCT {READING_HASH} AS row_hash, event_type AS device_id, CAST(NULL AS VARCHAR) AS room_id, CAST(NULL AS VARCHAR) AS location,
       'in' AS outin, CAST(ts AS DATE) AS noted_date, value AS temp_c FROM events WHERE value IS NOT NULL AND ts IS NOT NULL
"""
INCREMENTAL_SQL = f"""
WITH rows AS ({READING_ROWS})
SELECT *, CASE WHEN noted_date >= DATE '2024-01-17' THEN TIMESTAMP '2024-02-01 06:00:00' ELSE TIMESTAMP '2024-01-21 06:00:00' END AS load_dttm
FROM rows
"""


@query("row_hash_full", f"SELECT *, TIMESTAMP '2024-01-21 06:00:00' AS load_dttm FROM ({READING_ROWS})")
def row_hash_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_rows(inputs.day_readings(spark, sf_dir), temperature.CLEAN_COLUMNS, temperature.NOT_NULL, FIRST_RUN)


@query("row_hash_incremental", INCREMENTAL_SQL)
def row_hash_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target loaded up to 20 January, then everything from three days before that again."""
    readings = inputs.day_readings(spark, sf_dir)
    loaded = readings.where(F.col("noted_date") <= F.lit(date(2024, 1, 20)))
    target = full_rows(loaded, temperature.CLEAN_COLUMNS, temperature.NOT_NULL, FIRST_RUN)
    return incremental_rows(
        target, readings, temperature.CLEAN_COLUMNS, temperature.NOT_NULL, "noted_date", date(2024, 1, 20), SECOND_RUN
    )


@query("target_full_then_incremental", INCREMENTAL_SQL)
def target_full_then_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same loads as jobs on a stored target with a stored watermark."""
    readings = inputs.day_readings(spark, sf_dir)
    wh = Warehouse.create(spark, workspace(spark, "target"), SLICES)
    temperature.load_target(wh, readings.where(F.col("noted_date") <= F.lit(date(2024, 1, 20))), "full", FIRST_RUN)
    temperature.load_target(wh, readings, "incremental", SECOND_RUN)
    return wh.read("target", temperature.TARGET)


@query("incremental_extract", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'")
def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return since(table(spark, sf_dir, "events"), "ts", datetime(2024, 1, 20, 12))


@query("incremental_extract_lookback", "SELECT event_id, ts, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-17 12:00:00'")
def incremental_extract_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return since(table(spark, sf_dir, "events"), "ts", datetime(2024, 1, 20, 12), 3).select("event_id", "ts", "user_id")


@query(
    "watermark_advance",
    """
    SELECT 'events' AS source_name, 'ts' AS watermark_field, max(ts) AS last_watermark_value, 'success' AS last_status FROM events
    UNION ALL SELECT 'orders', 'o_orderdate', max(o_orderdate), 'success' FROM orders
    UNION ALL SELECT 'idle', 'ts', NULL, 'never_run'
    """,
)
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded rows, two sources advanced to their newest row, one that had nothing to load."""
    wh = Warehouse.create(spark, workspace(spark, "watermarks"), SLICES)
    fields = {"events": "ts", "orders": "o_orderdate", "idle": "ts"}
    seed_watermarks(wh, fields)
    current = seed_watermarks(wh, fields)
    for name in ("events", "orders"):
        newest = table(spark, sf_dir, name).agg(F.max(fields[name])).first()[0]
        advance_watermark(wh, name, fields[name], newest, current[name], FIRST_RUN)
    advance_watermark(wh, "idle", "ts", None, current["idle"], FIRST_RUN)
    return watermarks(wh).drop("last_run_at")
