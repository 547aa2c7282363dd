"""Topic messages and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.plans import warehouse
from martloom.plans.warehouse import SOURCES
from martloom.queries import inputs
from martloom.queries.loading import SLICES
from martloom.queries.pipelines import FIRST_RUN
from martloom.queries.registry import query, table
from martloom.session import workspace
from martloom.sinks.topics import messages, publish
from martloom.sinks.warehouse import Warehouse
from martloom.sources.topics import decoded, message_files
from martloom.streaming.replicate import replicate
from martloom.streaming.upserts import merge_stream

MESSAGE = "station_id STRING, sensor_type STRING, value DOUBLE"


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as recorded topic messages; ``error`` events carry a value that is no JSON."""
    doc = F.to_json(F.struct(F.col("user_id").cast("string").alias("station_id"), F.col("event_type").alias("sensor_type"), "value"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("event_type") == "error", F.lit("not json")).otherwise(doc).alias("value"),
        F.lit("sensors").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


DOCUMENTS_SQL = """
SELECT 'sensors-' || (user_id % 4) || '-' || event_id AS _id,
       CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS station_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS sensor_type, CASE WHEN event_type <> 'error' THEN value END AS value,
       ts AS _timestamp, CAST(user_id % 4 AS INTEGER) AS _partition, event_id AS _offset,
       CASE WHEN event_type = 'error' THEN 'not json' END AS _corrupt_record
FROM events
"""


@query("topic_batch", DOCUMENTS_SQL)
def topic_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic read once from beginning to end and decoded."""
    return decoded(event_messages(spark, sf_dir), MESSAGE)


@query("topic_preview", f"{DOCUMENTS_SQL} ORDER BY ts, _id LIMIT 10")
def topic_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten oldest documents, for a look."""
    return decoded(event_messages(spark, sf_dir), MESSAGE).orderBy("_timestamp", "_id").limit(10)


@query("stream_replicate", DOCUMENTS_SQL)
def stream_replicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded messages streamed into a document table, in two starts of the same stream."""
    work = workspace(spark, "replicate")
    recorded = event_messages(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    early = F.col("timestamp") < "2024-01-16"
    for part in (early, ~early):
        recorded.where(part).write.mode("append").json(f"{work}/topic")
        stream = message_files(spark, f"{work}/topic", stream=True, files_per_trigger=64)
        replicate(stream, MESSAGE, f"{work}/documents", f"{work}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{work}/documents")


@query("stream_replicate_dedup", DOCUMENTS_SQL)
def stream_replicate_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, but every message of a week is delivered again in the second start, and some twice in a batch."""
    work = workspace(spark, "replicate-dedup")
    recorded = event_messages(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    twice = recorded.where("offset % 7 = 0")
    for part in (F.col("timestamp") < "2024-01-16", F.col("timestamp") >= "2024-01-09"):
        recorded.where(part).unionByName(twice.where(part)).write.mode("append").json(f"{work}/topic")
        stream = message_files(spark, f"{work}/topic", stream=True, files_per_trigger=64)
        replicate(stream, MESSAGE, f"{work}/documents", f"{work}/checkpoint", once=True, within="60 days").awaitTermination()
    return spark.read.parquet(f"{work}/documents")


@query(
    "stream_upsert",
    """
    WITH d AS (SELECT *, o_orderdate + to_microseconds(CAST(CAST(o_totalprice AS DECIMAL(18,6)) * 1000000 AS BIGINT)) AS u FROM orders)
    SELECT CAST(o_custkey AS VARCHAR) AS ticket_id, o_orderdate AS created_at, u AS updated_at, o_orderpriority AS issue_type FROM d
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY u DESC, o_orderkey DESC) = 1
    """,
)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A growing ticket source merged by a stream. Newer tickets arrive first: the late ones must not win."""
    work = workspace(spark, "upserts")
    source = SOURCES["support_tickets"]
    docs = inputs.ticket_docs(spark, sf_dir, key="o_custkey")
    wh = Warehouse.create(spark, f"{work}/warehouse", SLICES)
    newer = F.year("created_at") >= 1998
    for part in (newer, ~newer):
        docs.where(part).write.mode("append").parquet(f"{work}/source")
        stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 64).parquet(f"{work}/source")
        merge_stream(wh, source, stream, f"{work}/checkpoint", once=True, clock=lambda: FIRST_RUN).awaitTermination()
    rows = wh.read("dwh/support_tickets", warehouse.SUPPORT_TICKETS)
    return rows.select("ticket_id", "created_at", "updated_at", "issue_type")


@query(
    "publish_messages",
    """
    SELECT CAST(c_mktsegment AS VARCHAR) AS key, 'customers' AS topic, c_custkey, c_name, c_acctbal FROM customer
    """,
)
def publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as keyed JSON messages, written as JSON lines and decoded again."""
    work = workspace(spark, "publish")
    rows = table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", "c_name", "c_acctbal")
    publish(messages(rows, "c_mktsegment", "customers"), "json", f"{work}/topic")
    sent = spark.read.schema("key STRING, value STRING, topic STRING").json(f"{work}/topic")
    doc = F.from_json("value", "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE").alias("doc")
    return sent.select("key", "topic", doc).select("key", "topic", "doc.*")
