"""Bad input: null keys, refused batches, texts that cannot be read; and landing of files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.times import moment
from martloom.operators.merge import upsert
from martloom.operators.quality import QualityError
from martloom.plans import incremental, marts, payload_files, temperature, warehouse
from martloom.queries import inputs
from martloom.queries.loading import SLICES
from martloom.queries.merging import RUN_TS
from martloom.queries.pipelines import FIRST_RUN, HALF, MID_1998, SECOND_RUN, SESSION_SQL, SESSION_VERSIONS, TICKET_SQL, two_runs
from martloom.queries.registry import query, table
from martloom.session import workspace
from martloom.sinks.warehouse import Warehouse


@query("merge_null_keys", "SELECT nullif(c_nationkey, 0) AS nation, count(*) AS n FROM customer GROUP BY 1")
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges of rows of which one has a null key: there is still one such row."""
    nation = F.nullif(F.col("c_nationkey"), F.lit(0)).alias("nation")
    rows = table(spark, sf_dir, "customer").groupBy(nation).agg(F.count(F.lit(1)).alias("n"))
    once = upsert(rows.where("nation > 12"), rows, ["nation"], ["n"], RUN_TS)
    return upsert(once, rows, ["nation"], ["n"], RUN_TS)


@query("refused_merge", SESSION_SQL)
def refused_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the sessions, then a batch with a null key that must change nothing, then the rest."""
    docs = inputs.session_docs(spark, sf_dir)
    wh = Warehouse.create(spark, workspace(spark, "refused"), SLICES)
    incremental.run(wh, {"user_sessions": docs.where(F.col("start_time") < moment(HALF))}, FIRST_RUN)
    broken = docs.withColumn("session_id", F.when(F.col("start_time") < moment(datetime(2024, 1, 20)), F.col("session_id")))
    try:
        incremental.run(wh, {"user_sessions": broken}, datetime(2024, 2, 1, 18, 0))
    except QualityError:
        incremental.run(wh, {"user_sessions": docs}, SECOND_RUN)
    return wh.read("dwh/user_sessions", warehouse.USER_SESSIONS)


@query(
    "gated_run_actions",
    f"""
    SELECT session_id, CAST(unnest(range(1, len(w) + 1)) AS INTEGER) AS action_order, unnest(w) AS action_name
    FROM (SELECT session_id, regexp_extract_all(event_type, '[aeiou]') AS w FROM ({SESSION_VERSIONS}))
    """,
)
def gated_run_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = two_runs(spark, "user_sessions", inputs.session_docs(spark, sf_dir), HALF)
    return wh.read("dwh/session_actions", warehouse.SESSION_ACTIONS).drop("loaded_at")


@query(
    "gated_run_messages",
    f"""
    SELECT ticket_id, message_order, CASE WHEN message_order % 2 = 1 THEN 'user' ELSE 'support' END AS sender, message_text, message_timestamp
    FROM (SELECT ticket_id, CAST(unnest(range(1, len(w) + 1)) AS INTEGER) AS message_order, unnest(w) AS message_text, created_at AS message_timestamp
          FROM (SELECT *, string_split(issue_type, '-') AS w FROM ({TICKET_SQL})))
    """,
)
def gated_run_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = two_runs(spark, "support_tickets", inputs.ticket_docs(spark, sf_dir, key="o_custkey"), MID_1998)
    return wh.read("dwh/ticket_messages", warehouse.TICKET_MESSAGES).drop("loaded_at")


@query(
    "gated_run_efficiency",
    f"SELECT * EXCLUDE (loaded_at, dwh_updated_at), ticket_id AS user_id FROM ({TICKET_SQL})",
)
def gated_run_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mart by name, over the tickets of two runs."""
    wh = two_runs(spark, "support_tickets", inputs.ticket_docs(spark, sf_dir, key="o_custkey"), MID_1998)
    marts.build(wh, SECOND_RUN, ["support_efficiency"])
    return wh.read("mart/support_efficiency", marts.SUPPORT_EFFICIENCY)


@query(
    "reject_counts_csv",
    """
    SELECT 'readings_unreadable_noted_date' AS check_name, count(*) AS error_count FROM orders
    WHERE o_orderstatus IN ('O', 'F') AND o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'readings_unreadable_temp_c', count(*) FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice > 400000
    """,
)
def reject_counts_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a tolerant load of CSV files writes about texts it cannot read."""
    work = workspace(spark, "rejects")
    raw = inputs.temperature_text(spark, sf_dir, keep=["o_orderpriority", "o_totalprice"])
    day = F.when(F.col("o_orderpriority") == "1-URGENT", "today").otherwise(F.col("noted_date")).alias("noted_date")
    temp = F.when(F.col("o_totalprice") > 400000, "n/a").otherwise(F.col("temp")).alias("temp")
    raw.select("id", day, temp, "out_in").write.option("header", True).csv(f"{work}/in")
    temperature.build_clean(spark, f"{work}/in", work, strict=False)
    return spark.read.parquet(f"{work}/rejects")


@query(
    "reject_counts_json",
    "SELECT 'payloads_unreadable' AS check_name, count(*) AS error_count FROM customer WHERE c_custkey % 5 IN (0, 1)",
)
def reject_counts_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads cut off in the middle, or with text where a list belongs."""
    good = F.concat(F.lit('{"pets":[{"name":"'), F.col("c_name"), F.lit('"}]}'))
    cut = F.substring(good, F.lit(1), F.length(good) - 3)
    payload = F.when(F.col("c_custkey") % 5 == 0, cut).when(F.col("c_custkey") % 5 == 1, '{"pets":"none"}').otherwise(good)
    return payload_files.unreadable_payloads(table(spark, sf_dir, "customer").select(payload.alias("payload")))


@query(
    "reject_counts_xml",
    """
    SELECT 'payloads_unreadable' AS check_name, count(*) AS error_count FROM part WHERE p_partkey % 7 = 0
    UNION ALL SELECT 'foods_null_name', count(*) FROM part WHERE p_partkey % 7 = 1
    UNION ALL SELECT 'foods_unreadable_serving_g', count(*) FROM part WHERE p_partkey % 7 <> 0 AND p_size > 45
    UNION ALL SELECT 'foods_unreadable_' || name, 0 FROM (SELECT unnest(['calories_total', 'calories_fat', 'total_fat', 'saturated_fat',
      'cholesterol', 'sodium', 'carb', 'fiber', 'protein']) AS name)
    """,
)
def reject_counts_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads cut off in the middle, foods without a name, and words where a number belongs."""
    name = F.when(F.col("p_partkey") % 7 == 1, "").otherwise(F.concat(F.lit("<name>"), F.col("p_name"), F.lit("</name>")))
    serving = F.when(F.col("p_size") > 45, "plenty").otherwise(F.col("p_size").cast("string"))
    good = F.concat(F.lit("<nutrition><food>"), name, F.lit('<serving units="g">'), serving, F.lit("</serving></food></nutrition>"))
    payload = F.when(F.col("p_partkey") % 7 == 0, F.substring(good, F.lit(1), F.length(good) - 9)).otherwise(good)
    return payload_files.food_rejects(table(spark, sf_dir, "part").select(payload.alias("payload")))


@query(
    "landed_files",
    """
    SELECT 'json' AS file_type, string_agg('{"pets":[{"name":"' || c_name || '"}]}' || chr(10), '' ORDER BY c_custkey) AS payload,
           TIMESTAMP '2024-01-21 06:00:00' AS loaded_at
    FROM customer GROUP BY c_nationkey
    """,
)
def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for the customers of each nation, landed whole and read back from the raw table."""
    work = workspace(spark, "landing")
    text = F.concat(F.lit('{"pets":[{"name":"'), F.col("c_name"), F.lit('"}]}')).alias("value")
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", text).repartition("c_nationkey")
    rows.sortWithinPartitions("c_nationkey", "c_custkey").drop("c_custkey").write.partitionBy("c_nationkey").text(f"{work}/files")
    payload_files.land(spark, work, f"{work}/files/*", "json", datetime(2024, 1, 21, 6, 0))
    return payload_files.landed(spark, work).select("file_type", "payload", "loaded_at")
