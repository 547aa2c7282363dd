"""A growing document source merged batch by batch; the checkpoint stands in for the watermark."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.plans.incremental import merge, stage_rows
from martloom.plans.warehouse import Source
from martloom.session import STATE_STORE, setting
from martloom.sinks.runlog import RunLog, new_run_id, utc_now
from martloom.sinks.warehouse import Warehouse
from martloom.sources.documents import SourceSpec, raw_rows


def changed_winners(docs: DataFrame, spec: SourceSpec) -> DataFrame:
    """Of every key whose newest document changed in a micro-batch, that document as a raw row.

    The state holds the winner of each key with the time of the batch that brought it. Copies of a row that are sent
    again lose to the first, so neither they nor late rows make a key look changed. Equal times are settled by content,
    whichever batch came first. Null keys are one key, and a null time counts as newest, as in a batch. Rows of a
    key are folded inside the map tasks before they reach the state.
    """
    time = spec.staged_field
    rows = raw_rows(docs, spec).withColumn("_seen", F.unix_micros(F.current_timestamp()))
    rank = F.struct(F.col(time).isNull().alias("open"), time, "id", (-F.col("_seen")).alias("first"))
    winner = F.struct("source_doc", time, "id", "_seen")
    kept = rows.groupBy(spec.key).agg(F.max_by(winner, rank).alias("_row"))
    now = F.unix_micros(F.current_timestamp())
    return kept.select(spec.key, "_row.*").where(F.col("_seen") == now).drop("_seen")


def merge_stream(
    wh: Warehouse,
    source: Source,
    docs: DataFrame,
    checkpoint: str,
    once: bool = False,
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """Stage and merge what each micro-batch changes, and log the counts.

    Only new winners are staged, so a batch of replayed or late documents writes no slice. What the state does not know,
    such as keys of earlier batch loads, is merged as it comes and settled by the merge. A batch may be delivered twice:
    its id names its staging partition, which the second delivery replaces, and merging the same rows again gives the same
    tables. The number of shuffle partitions is kept from the first start on.
    """
    spec = source.spec
    log = RunLog(wh, new_run_id())

    def merge_batch(batch: DataFrame, number: int) -> None:
        batch_id = f"{spec.name}_stream_{number:012d}"
        run_ts = clock()
        try:
            with log.step("merge", spec.name, batch_id) as counts:
                staged = stage_rows(wh, source, batch, batch_id, run_ts)
                counts.update(extracted=staged.extracted, staged=staged.loaded)
                merged = merge(wh, source, batch_id, run_ts)
                counts.update(inserted=merged.inserted, updated=merged.updated, rejected=merged.rejected)
        finally:
            log.flush()

    writer = changed_winners(docs, spec).writeStream.outputMode("update").foreachBatch(merge_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    with setting(wh.spark, "spark.sql.streaming.stateStore.providerClass", STATE_STORE):
        return (writer.trigger(availableNow=True) if once else writer).start()
