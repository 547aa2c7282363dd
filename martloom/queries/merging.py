"""Latest versions and merges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.documents import to_document
from martloom.functions.times import moment
from martloom.operators.latest import latest_version, newest_first
from martloom.operators.merge import insert_ignore, replace_children, split_rejects, upsert
from martloom.plans import warehouse
from martloom.queries import inputs
from martloom.queries.registry import query, table

RUN_TS = datetime(2024, 2, 1, 6, 0)
LOADED = "TIMESTAMP '2024-01-01 00:00:00'"
SPLIT = "TIMESTAMP '1998-01-01 00:00:00'"
OVERLAP = "TIMESTAMP '1997-01-01 00:00:00'"


def stamp(text: str) -> Column:
    return moment(datetime.fromisoformat(text.split("'")[1]))


@query(
    "latest_version",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) = 1
    """,
)
def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    latest = latest_version(orders, ["o_custkey"], newest_first("o_orderdate", "o_orderkey"))
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


def order_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before the split, as a table loaded earlier."""
    older = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < stamp(SPLIT))
    return older.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", stamp(LOADED).alias("loaded_at"), stamp(LOADED).alias("updated_at")
    )


def order_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from the overlap on, with another status and price."""
    newer = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= stamp(OVERLAP))
    return newer.select("o_orderkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"))


@query(
    "upsert_merge",
    f"""
    WITH t AS (SELECT * FROM orders WHERE o_orderdate < {SPLIT}), u AS (SELECT * FROM orders WHERE o_orderdate >= {OVERLAP})
    SELECT coalesce(t.o_orderkey, u.o_orderkey) AS o_orderkey,
           CASE WHEN u.o_orderkey IS NOT NULL THEN 'U' ELSE t.o_orderstatus END AS o_orderstatus,
           CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_totalprice * 2 ELSE t.o_totalprice END AS o_totalprice,
           CASE WHEN t.o_orderkey IS NOT NULL THEN {LOADED} ELSE TIMESTAMP '2024-02-01 06:00:00' END AS loaded_at,
           CASE WHEN u.o_orderkey IS NOT NULL THEN TIMESTAMP '2024-02-01 06:00:00' ELSE {LOADED} END AS updated_at
    FROM t FULL JOIN u ON t.o_orderkey = u.o_orderkey
    """,
)
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderstatus", "o_totalprice"]
    return upsert(
        order_target(spark, sf_dir), order_updates(spark, sf_dir), ["o_orderkey"], columns, RUN_TS, "loaded_at", "updated_at"
    )


@query(
    "insert_ignore",
    f"""
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < {SPLIT}
    UNION ALL
    SELECT o_orderkey, 'U', o_totalprice * 2 FROM orders
    WHERE o_orderdate >= {OVERLAP} AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < {SPLIT})
    """,
)
def insert_ignore_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = order_target(spark, sf_dir).select("o_orderkey", "o_orderstatus", "o_totalprice")
    return insert_ignore(target, order_updates(spark, sf_dir), ["o_orderkey"])


@query(
    "replace_children",
    """
    WITH changed AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    SELECT l_orderkey, l_linenumber, l_quantity, 'kept' AS origin FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM changed)
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_quantity, 'new' FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM changed) AND l_returnflag <> 'R'
    """,
)
def replace_children_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of changed orders replaced by a shorter list; all other lines stay."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    changed = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    fresh = lines.where(F.col("l_returnflag") != "R").join(changed, "l_orderkey", "left_semi").withColumn("origin", F.lit("new"))
    target = lines.withColumn("origin", F.lit("kept")).drop("l_returnflag")
    return replace_children(target, changed, fresh, "l_orderkey")


@query(
    "reject_untyped",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CASE WHEN event_type = 'error' THEN 'stale' ELSE event_type END AS event_type,
           TIMESTAMP '2024-01-01 00:00:00' AS loaded_at,
           CASE WHEN event_type = 'error' THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 06:00:00' END AS updated_at
    FROM events
    """,
)
def reject_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose new version has no type are not merged: the old row stays as it was."""
    docs = inputs.event_docs(spark, sf_dir)
    rows = warehouse.events(docs.select("event_id", to_document(docs.columns).alias("source_doc")))
    accepted, _ = split_rejects(rows.select("event_id", "event_type"), F.col("event_type").isNotNull())
    target = docs.select("event_id", F.lit("stale").alias("event_type"), stamp(LOADED).alias("loaded_at"), stamp(LOADED).alias("updated_at"))
    return upsert(target, accepted, ["event_id"], ["event_type"], RUN_TS, "loaded_at", "updated_at")


@query(
    "rejected_rows",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp FROM events WHERE event_type = 'error'",
)
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.event_docs(spark, sf_dir)
    rows = warehouse.events(docs.select("event_id", to_document(docs.columns).alias("source_doc")))
    return split_rejects(rows, F.col("event_type").isNotNull())[1].select("event_id", "event_timestamp")
