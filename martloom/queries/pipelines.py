"""Whole incremental runs on a warehouse of their own."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.times import moment
from martloom.plans import incremental, marts, warehouse
from martloom.plans.warehouse import SOURCES
from martloom.queries import inputs
from martloom.queries.loading import SLICES
from martloom.queries.marts import activity_sql
from martloom.queries.registry import query
from martloom.session import workspace
from martloom.sinks.runlog import JOB_LOG
from martloom.sinks.warehouse import Warehouse

HALF = datetime(2024, 1, 16)
MID_1998 = datetime(1998, 7, 1)
FIRST_RUN, SECOND_RUN = datetime(2024, 2, 1, 6, 0), datetime(2024, 2, 2, 6, 0)


def two_runs(spark: SparkSession, source: str, docs: DataFrame, half: datetime) -> Warehouse:
    """The source as it stood at ``half``, then as it stands at the end; the second run takes what is new."""
    field = SOURCES[source].spec.watermark_field
    wh = Warehouse.create(spark, workspace(spark, source), SLICES)
    incremental.run(wh, {source: docs.where(F.col(field) < moment(half))}, FIRST_RUN)
    incremental.run(wh, {source: docs}, SECOND_RUN)
    return wh


SESSION_VERSIONS = """
SELECT *, CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1
"""
SESSION_SQL = f"""
SELECT session_id, CAST(user_id AS VARCHAR) AS user_id, ts AS start_time,
       ts + to_microseconds(CAST(CAST(value AS DECIMAL(18,6)) * 1000000 AS BIGINT)) AS end_time,
       CAST(round(CAST(value AS DECIMAL(18,6)), 0) AS INTEGER) AS session_duration_seconds,
       event_type AS device_type, json_extract_string(props, '$.k') AS device_os, CAST(NULL AS VARCHAR) AS device_browser,
       CAST(len(regexp_extract_all(props, '[0-9]')) AS INTEGER) AS pages_visited_count,
       CAST(len(regexp_extract_all(event_type, '[aeiou]')) AS INTEGER) AS actions_count,
       CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN TIMESTAMP '2024-02-01 06:00:00' ELSE TIMESTAMP '2024-02-02 06:00:00' END AS loaded_at,
       CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN TIMESTAMP '2024-02-01 06:00:00' ELSE TIMESTAMP '2024-02-02 06:00:00' END AS updated_at
FROM ({SESSION_VERSIONS})
"""


@query("gated_run", SESSION_SQL)
def gated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = two_runs(spark, "user_sessions", inputs.session_docs(spark, sf_dir), HALF)
    return wh.read("dwh/user_sessions", warehouse.USER_SESSIONS)


@query(
    "gated_run_children",
    f"""
    SELECT session_id, CAST(unnest(range(1, len(w) + 1)) AS INTEGER) AS page_order, unnest(w) AS page_url
    FROM (SELECT session_id, regexp_extract_all(props, '[0-9]') AS w FROM ({SESSION_VERSIONS}))
    """,
)
def gated_run_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = two_runs(spark, "user_sessions", inputs.session_docs(spark, sf_dir), HALF)
    return wh.read("dwh/session_pages", warehouse.SESSION_PAGES).drop("loaded_at")


@query(
    "gated_run_events",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp, event_type, event_type AS detail_page,
           json_extract_string(props, '$.k') AS detail_product_id,
           CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN TIMESTAMP '2024-02-01 06:00:00' ELSE TIMESTAMP '2024-02-02 06:00:00' END AS loaded_at
    FROM events WHERE event_type <> 'error'
    """,
)
def gated_run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a type are turned away by the merge and counted in the run log."""
    wh = two_runs(spark, "event_logs", inputs.event_docs(spark, sf_dir), HALF)
    return wh.read("dwh/event_logs", warehouse.EVENT_LOGS).drop("source_details", "updated_at")


TICKET_SQL = """
WITH d AS (SELECT *, o_orderdate + to_microseconds(CAST(CAST(o_totalprice AS DECIMAL(18,6)) * 1000000 AS BIGINT)) AS u FROM orders),
v AS (SELECT o_custkey, max(u) AS last, min(u) AS first FROM d GROUP BY o_custkey)
SELECT CAST(d.o_custkey AS VARCHAR) AS ticket_id,
       CASE d.o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'P' THEN 'in_progress' ELSE 'open' END AS status,
       d.o_orderpriority AS issue_type, d.o_orderdate AS created_at, d.u AS updated_at,
       CASE WHEN d.o_orderstatus = 'F' THEN CAST(floor(CAST(o_totalprice AS DECIMAL(18,2)) * 100 / 3600 + 0.5) / 100 AS DECIMAL(12,2)) END AS resolution_time_hours,
       CAST(len(string_split(d.o_orderpriority, '-')) AS INTEGER) AS message_count, d.o_orderstatus <> 'F' AS is_open,
       CASE WHEN v.first < TIMESTAMP '1998-07-01 00:00:00' THEN TIMESTAMP '2024-02-01 06:00:00' ELSE TIMESTAMP '2024-02-02 06:00:00' END AS loaded_at,
       CASE WHEN v.last < TIMESTAMP '1998-07-01 00:00:00' THEN TIMESTAMP '2024-02-01 06:00:00' ELSE TIMESTAMP '2024-02-02 06:00:00' END AS dwh_updated_at
FROM d JOIN v ON d.o_custkey = v.o_custkey AND d.u = v.last
"""


@query("gated_run_tickets", TICKET_SQL)
def gated_run_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticket per customer, its orders as versions: many rows are updated by the second run."""
    wh = two_runs(spark, "support_tickets", inputs.ticket_docs(spark, sf_dir, key="o_custkey"), MID_1998)
    return wh.read("dwh/support_tickets", warehouse.SUPPORT_TICKETS).drop("user_id")


@query(
    "gated_run_marts",
    "SELECT *, TIMESTAMP '2024-02-02 06:00:00' AS updated_at FROM ("
    + activity_sql(
        "SELECT user_id, device_type AS device, session_duration_seconds AS seconds, pages_visited_count AS pages,"
        f" actions_count AS actions, start_time AS started FROM ({SESSION_SQL})"
    )
    + ")",
)
def gated_run_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = two_runs(spark, "user_sessions", inputs.session_docs(spark, sf_dir), HALF)
    marts.build(wh, SECOND_RUN)
    return wh.read("mart/user_activity", marts.USER_ACTIVITY)


@query(
    "run_log_counts",
    """
    WITH r AS (SELECT ts < TIMESTAMP '2024-01-16 00:00:00' AS early, event_type FROM events)
    SELECT 'extract' AS job_name, CASE WHEN early THEN 'event_logs_20240201T060000' ELSE 'event_logs_20240202T060000' END AS batch_id,
           count(*) AS rows_extracted, count(*) AS rows_loaded_staging, CAST(0 AS BIGINT) AS rows_merged_dwh, CAST(0 AS BIGINT) AS rows_rejected, 'success' AS status FROM r GROUP BY early
    UNION ALL
    SELECT 'merge', CASE WHEN early THEN 'event_logs_merge_20240201T060000' ELSE 'event_logs_merge_20240202T060000' END,
           CAST(0 AS BIGINT), CAST(0 AS BIGINT), count_if(event_type <> 'error'), count_if(event_type = 'error'), 'success' FROM r GROUP BY early
    """,
)
def run_log_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = two_runs(spark, "event_logs", inputs.event_docs(spark, sf_dir), HALF)
    log = wh.log("job_log", JOB_LOG).where(F.col("job_name").isin("extract", "merge"))
    return log.select("job_name", "batch_id", "rows_extracted", "rows_loaded_staging", "rows_merged_dwh", "rows_rejected", "status")


@query(
    "staging_batch",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS source_timestamp, TIMESTAMP '2024-02-01 06:00:00' AS extracted_at,
           'event_logs_20240201T060000' AS batch_id,
           '{"event_id":"' || event_id || '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","event_type":"'
             || CASE WHEN event_type = 'error' THEN '' ELSE event_type END || '","details":{"page":"' || event_type || '","product_id":"'
             || json_extract_string(props, '$.k') || '","source":"props"}}' AS source_doc
    FROM events
    """,
)
def staging_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as staged documents, the batch written twice under one id as after a retry."""
    source, batch_id = SOURCES["event_logs"], "event_logs_20240201T060000"
    docs = inputs.event_docs(spark, sf_dir)
    wh = Warehouse.create(spark, workspace(spark, "staging"), SLICES)
    for _ in range(2):
        incremental.stage(wh, source, docs, batch_id, FIRST_RUN)
    return wh.staging("event_logs", source.spec.staging_schema).drop("id")
