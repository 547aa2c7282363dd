"""Marts and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.aggregates import mode, profile
from martloom.operators.merge import upsert
from martloom.plans import marts, warehouse
from martloom.queries.merging import RUN_TS
from martloom.queries.registry import query, table


def session_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of the session table, without the way through documents."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("start_time"),
        F.col("event_type").alias("device_type"),
        F.round(F.col("value").cast("decimal(18,6)"), 0).cast("int").alias("session_duration_seconds"),
        F.get_json_object("props", "$.k").cast("int").alias("pages_visited_count"),
        F.length("event_type").alias("actions_count"),
    )


def activity_sql(sessions: str) -> str:
    """The mart over any statement with user_id, device, seconds, pages, actions and started.

    The favourite is the key of the largest count in a histogram of each user's devices, the first by name among equals.
    """
    return f"""
    SELECT user_id, count(*) AS total_sessions,
           CAST(floor(CAST(sum(seconds) AS DECIMAL(24,4)) * 100 / count(seconds) + 0.5) / 100 AS DECIMAL(12,2)) AS avg_session_duration_seconds,
           CAST(sum(pages) AS BIGINT) AS total_pages_visited, CAST(sum(actions) AS BIGINT) AS total_actions, max(started) AS last_session_at,
           list_sort(list_filter(map_entries(histogram(device)), lambda e: e.value = list_max(map_values(histogram(device)))))[1].key AS favorite_device_type
    FROM ({sessions}) GROUP BY user_id
    """


ACTIVITY_SQL = activity_sql(
    "SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS device, CAST(round(CAST(value AS DECIMAL(18,6)), 0) AS INTEGER) AS seconds,"
    " CAST(json_extract_string(props, '$.k') AS INTEGER) AS pages, length(event_type) AS actions, ts AS started FROM events"
)


@query("user_activity_mart", ACTIVITY_SQL)
def user_activity_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.user_activity(session_table(spark, sf_dir))


@query("user_activity_joined", ACTIVITY_SQL)
def user_activity_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.user_activity_joined(session_table(spark, sf_dir))


@query(
    "favorite_type",
    """
    SELECT l_suppkey, l_returnflag AS favorite FROM (
      SELECT l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_returnflag ASC NULLS LAST) AS rn
      FROM lineitem GROUP BY l_suppkey, l_returnflag) WHERE rn = 1
    """,
)
def favorite_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mode(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_returnflag", "favorite")


def ticket_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of the ticket table; the total price in seconds passes until the last update."""
    created = F.col("o_orderdate")
    updated = created + F.make_dt_interval(secs=F.col("o_totalprice").cast("decimal(18,6)"))
    status = F.when(F.col("o_orderstatus") == "F", "closed").when(F.col("o_orderstatus") == "P", "in_progress").otherwise("new")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("ticket_id"), F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderpriority").alias("issue_type"), status.alias("status"), created.alias("created_at"), updated.alias("updated_at"),
        warehouse.resolution_hours(status, created, updated).alias("resolution_time_hours"),
        F.size(F.split("o_orderpriority", "-")).alias("message_count"), warehouse.is_open(status).alias("is_open"),
    )


TICKETS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS ticket_id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS issue_type,
       CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'P' THEN 'in_progress' ELSE 'new' END AS status, o_orderdate AS created_at,
       o_orderdate + to_microseconds(CAST(CAST(o_totalprice AS DECIMAL(18,6)) * 1000000 AS BIGINT)) AS updated_at,
       CASE WHEN o_orderstatus = 'F' THEN CAST(floor(CAST(o_totalprice AS DECIMAL(18,2)) * 100 / 3600 + 0.5) / 100 AS DECIMAL(12,2)) END AS resolution_time_hours,
       CAST(len(string_split(o_orderpriority, '-')) AS INTEGER) AS message_count, o_orderstatus = 'P' AS is_open
FROM orders
"""


@query("ticket_efficiency_mart", TICKETS_SQL)
def ticket_efficiency_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart merged into an older state of itself, in which every ticket of before 1998 is still open."""
    tickets = marts.support_efficiency(ticket_table(spark, sf_dir))
    older = tickets.where(F.year("created_at") < 1998).withColumns(
        {"status": F.lit("open"), "is_open": F.lit(True), "resolution_time_hours": F.lit(None).cast("decimal(12,2)")}
    )
    return upsert(older, tickets, ["ticket_id"], [c for c in tickets.columns if c != "ticket_id"], RUN_TS)


@query("report_status", f"SELECT status, count(*) AS tickets FROM ({TICKETS_SQL}) GROUP BY status")
def report_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.status_distribution(ticket_table(spark, sf_dir))


@query(
    "report_resolution",
    f"""
    SELECT issue_type, CAST(floor(sum(resolution_time_hours) * 100 / count(resolution_time_hours) + 0.5) / 100 AS DECIMAL(12,2)) AS avg_resolution_hours
    FROM ({TICKETS_SQL}) GROUP BY issue_type
    """,
)
def report_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.average_resolution(ticket_table(spark, sf_dir))


@query("report_devices", f"SELECT favorite_device_type, count(*) AS users FROM ({ACTIVITY_SQL}) GROUP BY 1")
def report_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.favorite_devices(marts.user_activity(session_table(spark, sf_dir)))


@query(
    "layer_profile",
    "SELECT count(*) AS row_count, min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice FROM lineitem",
)
def layer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(table(spark, sf_dir, "lineitem"), "l_extendedprice")
