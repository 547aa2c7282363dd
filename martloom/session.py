"""Session defaults and the shared work folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
#: Keeps the state of streams on local disk in place of the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session(app_name: str = "martloom", **conf: str) -> SparkSession:
    """A session with the defaults the operators are tested under.

    Shuffle partitions are left to the cluster: set them to a small multiple of the total cores and
    let adaptive execution coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, below the cluster's shared checkpoint folder.

    Without one, a local master takes a folder below the warehouse directory; on a cluster it must be set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
