"""Continuous copy of a topic into a document table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.session import STATE_STORE, setting
from martloom.sources.topics import decoded


def replicate(
    messages: DataFrame,
    schema: str,
    out: str,
    checkpoint: str,
    once: bool = False,
    within: str | None = None,
    identity: Sequence[str] = ("_id",),
) -> StreamingQuery:
    """Append every message as a document with its id and position.

    The file sink records finished batches with the files, so a restart neither loses nor repeats a
    message. ``once`` takes what is there now, in as many batches as the source's limits give, and stops.

    With ``within``, a message is stored once however often it is sent within that time of event time, over batches and
    restarts; the state forgets a message that long after its own time. ``identity`` names what makes two messages one: the position
    for redelivery, the columns that the producer sets for a second send. Messages older than the newest by more than
    ``within`` when a batch begins can't be told from repeats: they are not stored, and progress counts them as
    ``numRowsDroppedByWatermark``. Without ``within`` nothing is left out.
    """
    docs = decoded(messages, schema)
    if within is not None:
        timed = docs.withColumn("_event", F.col("_timestamp").cast("timestamp")).withWatermark("_event", within)
        docs = timed.dropDuplicatesWithinWatermark(list(identity)).drop("_event")
    writer = docs.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).option("path", out)
    with setting(messages.sparkSession, "spark.sql.streaming.stateStore.providerClass", STATE_STORE):
        return (writer.trigger(availableNow=True) if once else writer).start()
