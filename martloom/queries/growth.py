"""What runs leave behind as history grows: homes of keys, marts kept up by changes, files landed, tables made anew."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.functions.times import moment
from martloom.operators.sliced_percentiles import percentiles_of_slices, sketches
from martloom.plans import incremental, marts, payload_files, temperature
from martloom.plans.warehouse import SOURCES
from martloom.queries import inputs
from martloom.queries.loading import SLICES
from martloom.queries.marts import activity_sql
from martloom.queries.pipelines import FIRST_RUN, MID_1998, SECOND_RUN, two_runs
from martloom.queries.registry import query, table
from martloom.session import workspace
from martloom.sinks.runlog import watermarks
from martloom.sinks.warehouse import Warehouse, local_rows, overwrite
from martloom.sources.files import csv_split_text, csv_text, first_csv

THIRDS = (datetime(2024, 1, 11), datetime(2024, 1, 21), datetime(2030, 1, 1))


@query(
    "mart_delta",
    activity_sql(
        "SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS device, CAST(round(CAST(value AS DECIMAL(18,6)), 0) AS INTEGER) AS seconds,"
        " len(regexp_extract_all(props, '[0-9]')) AS pages, len(regexp_extract_all(event_type, '[aeiou]')) AS actions, ts AS started"
        " FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 10 ORDER BY ts DESC, event_id DESC) = 1)"
    ),
)
def mart_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that get newer versions, on other devices too, in three runs: the mart is corrected after each, never computed anew."""
    docs = inputs.session_docs(spark, sf_dir, per_event=True)
    last_digit = F.col("session_id").cast("long") % 10
    docs = docs.withColumn("session_id", F.concat_ws("-", "user_id", last_digit))
    wh = Warehouse.create(spark, workspace(spark, "mart-delta"), SLICES)
    for day, until in enumerate(THIRDS, 1):
        run_ts = datetime(2024, 2, day, 6)
        incremental.run(wh, {"user_sessions": docs.where(F.col("start_time") < moment(until))}, run_ts)
        marts.refresh(wh, run_ts, ["user_activity"])
    return wh.read("mart/user_activity", marts.USER_ACTIVITY).drop("updated_at")


@query(
    "key_homes",
    f"""
    WITH d AS (SELECT *, o_orderdate + to_microseconds(CAST(CAST(o_totalprice AS DECIMAL(18,6)) * 1000000 AS BIGINT)) AS u FROM orders)
    SELECT CAST(o_custkey AS VARCHAR) AS key, CAST(year(min(u)) * 12 + month(min(u)) AS INTEGER) AS month FROM d GROUP BY o_custkey
    """,
)
def key_homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key is at home in the month it was first seen in, whatever versions came later."""
    wh = two_runs(spark, "support_tickets", inputs.ticket_docs(spark, sf_dir, key="o_custkey"), MID_1998)
    homes = wh.read(incremental.directory(SOURCES["support_tickets"]), incremental.DIRECTORY)
    return homes.select("key", F.expr(f"place DIV {SLICES}").cast("int").alias("month"))


@query("target_shrinks", "SELECT 'temperature' AS source_name, max(o_orderdate) AS last_watermark_value FROM orders WHERE o_orderdate < TIMESTAMP '1997-12-01'")
def target_shrinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load of a source that has lost its last months: the watermark is the newest date that is left."""
    readings = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("device_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("room_id", "location")],
        F.lit("in").alias("outin"),
        F.to_date("o_orderdate").alias("noted_date"),
        F.col("o_totalprice").alias("temp_c"),
    )
    wh = Warehouse.create(spark, workspace(spark, "shrinking"), SLICES)
    temperature.load_target(wh, readings, "full", FIRST_RUN)
    temperature.load_target(wh, readings.where(F.col("noted_date") < F.lit(date(1997, 12, 1))), "full", SECOND_RUN)
    return watermarks(wh).select(F.lit("temperature").alias("source_name"), "last_watermark_value")


@query(
    "landed_xml",
    """
    SELECT 'xml' AS file_type, string_agg('<order><key>' || o_orderkey || '</key></order>' || chr(10), '' ORDER BY o_orderkey) AS payload,
           TIMESTAMP '2024-01-21 06:00:00' AS loaded_at
    FROM orders GROUP BY year(o_orderdate), month(o_orderdate)
    """,
)
def landed_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per month of orders, landed whole and read back from the raw table."""
    work = workspace(spark, "landing-xml")
    text = F.concat(F.lit("<order><key>"), F.col("o_orderkey").cast("string"), F.lit("</key></order>")).alias("value")
    rows = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMM").alias("month"), "o_orderkey", text)
    files = rows.repartition("month").sortWithinPartitions("month", "o_orderkey").drop("o_orderkey")
    files.write.partitionBy("month").text(f"{work}/files")
    payload_files.land(spark, work, f"{work}/files/*", "xml", datetime(2024, 1, 21, 6, 0))
    return payload_files.landed(spark, work).select("file_type", "payload", "loaded_at")


@query("first_csv_of_folder", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part WHERE p_partkey % 5 = 1")
def first_csv_of_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts dealt over five CSV files: the first by name is read."""
    work = workspace(spark, "first-csv")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.pmod(F.col("p_partkey") - 1, F.lit(5)).alias("n"))
    parts.repartition("n").write.partitionBy("n").option("header", True).csv(work)
    return csv_text(spark, first_csv(spark, work), ["p_partkey", "p_name"])


@query("csv_quoted_breaks", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents WHERE text <> ''")
def csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as CSV, with their line breaks and quotes, and read back by many tasks a file."""
    work = workspace(spark, "csv-breaks")
    docs = table(spark, sf_dir, "documents").where("text <> ''").select("doc_id", "text", "lang")
    plain = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "quoteAll": True}
    docs.write.option("header", True).options(**plain).csv(work)
    return csv_split_text(spark, work, ["doc_id", "text", "lang"])


@query("remade_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def remade_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made anew by the header of what is loaded: neither rows nor columns of the load before are left."""
    path = workspace(spark, "remade")
    customers = table(spark, sf_dir, "customer")
    overwrite(customers.select("c_custkey", "c_mktsegment"), path)
    overwrite(customers.select("c_custkey", "c_name", "c_acctbal"), path)
    return spark.read.parquet(path)


@query("staged_order", "SELECT count(*) AS n_rows, 0::BIGINT AS n_descents FROM events")
def staged_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a staged batch lie in the order of their time inside each file."""
    source = SOURCES["event_logs"]
    wh = Warehouse.create(spark, workspace(spark, "staged-order"), SLICES)
    incremental.stage(wh, source, inputs.event_docs(spark, sf_dir), "event_logs_1", FIRST_RUN)
    staged = spark.read.parquet(wh.path("staging/event_logs"))
    rows = staged.select("source_timestamp", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    before = F.lag("source_timestamp").over(Window.partitionBy("file").orderBy("place"))
    return rows.select((before > F.col("source_timestamp")).alias("descent")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("descent").alias("n_descents")
    )


@query(
    "percentiles_by_month",
    """
    SELECT round(quantile_cont(l_extendedprice, 0.05), 6) AS p05, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
           round(quantile_cont(l_extendedprice, 0.999), 6) AS p999 FROM lineitem
    """,
)
def percentiles_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sketch per month of shipping, written; exact percentiles over all months from these and one pruned scan."""
    path = workspace(spark, "month-sketches")
    lines = table(spark, sf_dir, "lineitem")
    overwrite(sketches(lines, "l_extendedprice", F.date_format("l_shipdate", "yyyy-MM")), path)
    found = percentiles_of_slices(lines, "l_extendedprice", spark.read.parquet(path), [0.05, 0.95, 0.999])
    return local_rows(spark, [tuple(round(value, 6) for value in found)], "p05 DOUBLE, p95 DOUBLE, p999 DOUBLE")


@query(
    "grown_clean_layer",
    """
    SELECT event_type AS device_id, CAST(ts AS DATE) AS noted_date, value AS temp_c FROM events
    WHERE value BETWEEN (SELECT quantile_cont(value, 0.05) FROM events) AND (SELECT quantile_cont(value, 0.95) FROM events)
    """,
)
def grown_clean_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that arrive in three batches, one of them twice: the clean layer is that of all readings at once."""
    work = workspace(spark, "grown-clean")
    readings = inputs.day_readings(spark, sf_dir)
    ends = [date(1970, 1, 1), *[until.date() for until in THIRDS]]
    for i in (0, 1, 2, 2):
        batch = readings.where((F.col("noted_date") >= F.lit(ends[i])) & (F.col("noted_date") < F.lit(ends[i + 1])))
        temperature.add_readings(spark, batch, work, f"batch-{i}")
    return temperature.grown_clean_layer(spark, work).select("device_id", "noted_date", "temp_c")
