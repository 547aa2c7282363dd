"""Publishing rows as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.documents import to_document


def messages(df: DataFrame, key: str, topic: str) -> DataFrame:
    """One message per row. The key is a column of the row, so messages spread over partitions by it."""
    return df.select(
        F.col(key).cast("string").alias("key"), to_document(df.columns).alias("value"), F.lit(topic).alias("topic")
    )


def publish(rows: DataFrame, fmt: str = "kafka", path: str | None = None, **options: str) -> None:
    """Send messages through the topic connector, or as JSON lines with ``fmt="json"``."""
    rows.write.format(fmt).mode("append").options(**options).save(path)
