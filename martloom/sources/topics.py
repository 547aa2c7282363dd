"""Message topics. Any frame with the columns key, value, topic, partition, offset, timestamp will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.hashing import message_id

MESSAGES = "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP_NTZ"
CORRUPT = "_corrupt_record"


def topic(spark: SparkSession, servers: str, name: str, **options: str) -> DataFrame:
    """A topic from its beginning to its present end, as a batch."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", name)
    return reader.option("startingOffsets", "earliest").option("endingOffsets", "latest").options(**options).load()


def topic_stream(spark: SparkSession, servers: str, name: str, **options: str) -> DataFrame:
    """A topic as a stream, from its beginning on the first start and from the checkpoint after that."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", name)
    return reader.option("startingOffsets", "earliest").options(**options).load()


def message_files(spark: SparkSession, path: str, stream: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """Recorded messages, one JSON object per line with the topic columns."""
    reader = spark.readStream if stream else spark.read
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.schema(MESSAGES).json(path)


def decoded(messages: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Documents with message id and position. A value that is no JSON keeps its text in ``_corrupt_record``."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = fields.fieldNames()
    full = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    body = messages.withColumn("doc", F.from_json(F.col("value").cast("string"), full, options))
    return body.select(
        message_id().alias("_id"),
        *[F.col("doc")[name].alias(name) for name in names],
        F.col("timestamp").alias("_timestamp"),
        F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"),
        F.col("doc")[CORRUPT].alias(CORRUPT),
    )
