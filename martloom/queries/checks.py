"""Quality rules over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.documents import to_document
from martloom.functions.times import elapsed_hours, elapsed_seconds
from martloom.operators.quality import all_checks, check, check_parent, check_unique, not_null, one_of
from martloom.plans import temperature, warehouse
from martloom.queries import inputs
from martloom.queries.registry import query, table

CHECKS_SQL = """
WITH s AS (SELECT o_orderdate AS start_time, l_shipdate AS end_time FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'user_sessions_null_session_id' AS check_name, count(*) AS error_count FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 7
UNION ALL SELECT 'user_sessions_negative_duration', count(*) FROM s WHERE end_time < start_time
UNION ALL SELECT 'user_sessions_invalid_time_range', count(*) FROM s WHERE end_time IS NOT NULL AND start_time > end_time
UNION ALL SELECT 'event_logs_null_event_id', count(*) FROM events WHERE event_id % 10 = 0
UNION ALL SELECT 'event_logs_null_event_type', count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'support_tickets_null_ticket_id', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 6
UNION ALL SELECT 'support_tickets_invalid_time_range', count(*) FROM s WHERE end_time < start_time
UNION ALL SELECT 'support_tickets_negative_resolution', count(*) FROM s WHERE round(epoch(end_time - start_time) / 3600.0, 2) < 0
UNION ALL SELECT 'support_tickets_null_status', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
"""


@query("quality_checks", CHECKS_SQL)
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine checks, over two passes: shipping before ordering makes bad sessions and bad tickets, some keys are null."""
    joined = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    key, start, end = F.col("l_orderkey").cast("string"), F.col("o_orderdate"), F.col("l_shipdate")
    facts = joined.select(
        F.when(F.col("l_linenumber") != 7, key).alias("session_id"), start.alias("start_time"), end.alias("end_time"),
        elapsed_seconds(start, end).alias("session_duration_seconds"),
        F.when(F.col("l_linenumber") != 6, key).alias("ticket_id"), start.alias("created_at"), end.alias("updated_at"),
        elapsed_hours(start, end).alias("resolution_time_hours"),
        F.when(F.col("l_returnflag") != "R", F.col("o_orderstatus")).alias("status"),
    )
    docs = inputs.event_docs(spark, sf_dir)
    named = F.when(F.col("event_id").cast("long") % 10 != 0, F.col("event_id")).alias("event_id")
    events = warehouse.events(docs.select(named, to_document(docs.columns).alias("source_doc")))
    return all_checks(
        [check(facts, [*warehouse.session_rules(), *warehouse.ticket_rules()]), check(events, warehouse.event_rules())]
    )


@query(
    "unreadable_texts",
    """
    SELECT 'readings_unreadable_noted_date' AS check_name, count(*) AS error_count FROM orders
    WHERE o_orderstatus IN ('O', 'F') AND o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'readings_unreadable_temp_c', count(*) FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice > 400000
    """,
)
def unreadable_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a tolerant load cannot read: urgent orders have no date but a word, dear ones no plain number."""
    raw = inputs.temperature_text(spark, sf_dir, keep=["o_orderpriority", "o_totalprice"])
    return temperature.reading_rejects(
        raw.withColumns(
            {
                "noted_date": F.when(F.col("o_orderpriority") == "1-URGENT", "today").otherwise(F.col("noted_date")),
                "temp": F.when(F.col("o_totalprice") > 400000, "n/a").otherwise(F.col("temp")),
            }
        )
    )


@query(
    "constraint_checks",
    """
    SELECT 'customer_duplicate_name' AS check_name, count(*) AS error_count FROM (SELECT c_name FROM customer GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'line_duplicate_number', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'line_orphan', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'urgent_line_orphan', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
    UNION ALL SELECT 'orders_invalid_o_orderstatus', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
    UNION ALL SELECT 'orders_null_o_custkey', count(*) FROM orders WHERE o_custkey % 7 = 0
    UNION ALL SELECT 'orders_null_o_orderdate', count(*) FROM orders WHERE o_custkey % 11 = 0
    """,
)
def constraint_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness, references, domains and required columns."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    gaps = orders.select(
        "o_orderstatus",
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_orderdate")).alias("o_orderdate"),
    )
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT")
    return all_checks(
        [
            check(gaps, [one_of("orders", "o_orderstatus", ["F", "O"]), *not_null("orders", "o_custkey", "o_orderdate")]),
            check_unique(table(spark, sf_dir, "customer"), "customer_duplicate_name", ["c_name"]),
            check_unique(lines, "line_duplicate_number", ["l_orderkey", "l_linenumber"]),
            check_parent(lines, orders, "line_orphan", "l_orderkey", "o_orderkey"),
            check_parent(lines, urgent, "urgent_line_orphan", "l_orderkey", "o_orderkey"),
        ]
    )
