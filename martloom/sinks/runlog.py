"""Run log and watermarks: append-only, one small write per run."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.latest import latest_version
from martloom.sinks.warehouse import Warehouse

JOB_LOG = (
    "job_name STRING, source_name STRING, run_id STRING, batch_id STRING, rows_extracted BIGINT, "
    "rows_loaded_staging BIGINT, rows_merged_dwh BIGINT, rows_updated_dwh BIGINT, rows_rejected BIGINT, "
    "status STRING, error_message STRING, started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ"
)
WATERMARKS = (
    "source_name STRING, watermark_field STRING, last_watermark_value TIMESTAMP_NTZ, "
    "last_run_at TIMESTAMP_NTZ, last_status STRING"
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_run_id() -> str:
    return str(uuid.uuid4())


@dataclass
class RunLog:
    """Collects the finished record of each step of a run and appends them in one write."""

    wh: Warehouse
    run_id: str = field(default_factory=new_run_id)
    records: list[tuple] = field(default_factory=list)

    @contextmanager
    def step(self, job: str, source: str | None = None, batch_id: str | None = None) -> Iterator[dict[str, int]]:
        """Counts the caller puts into the yielded dict are logged; a failure is logged and raised on."""
        counts: dict[str, int] = {}
        started, status, message = utc_now(), "success", None
        try:
            yield counts
        except Exception as error:
            status, message = "failed", str(error)
            raise
        finally:
            fields = ("extracted", "staged", "inserted", "updated", "rejected")
            numbers = [counts.get(name, 0) for name in fields]
            self.records.append((job, source, self.run_id, batch_id, *numbers, status, message, started, utc_now()))

    def flush(self) -> None:
        if self.records:
            self.wh.append_log("job_log", self.records, JOB_LOG)
            self.records = []


def watermarks(wh: Warehouse) -> DataFrame:
    """The current row of each source: the latest one written."""
    newest_first = [F.col("last_run_at").desc_nulls_last(), F.col("last_watermark_value").desc_nulls_last()]
    return latest_version(wh.log("watermarks", WATERMARKS), ["source_name"], newest_first)


def current_watermarks(wh: Warehouse) -> dict[str, datetime | None]:
    """Source -> watermark, null before the first load. One row per source reaches the driver."""
    return {row.source_name: row.last_watermark_value for row in watermarks(wh).collect()}


def seed_watermarks(wh: Warehouse, fields: Mapping[str, str]) -> dict[str, datetime | None]:
    """A ``never_run`` row for each source that has none; returns all watermarks. Safe to repeat."""
    known = current_watermarks(wh)
    missing = [(source, column, None, None, "never_run") for source, column in fields.items() if source not in known]
    if missing:
        wh.append_log("watermarks", missing, WATERMARKS)
    return {**{source: None for source in fields}, **known}


def advance_watermark(
    wh: Warehouse, source: str, column: str, newest: datetime | None, current: datetime | None, run_ts: datetime
) -> datetime | None:
    """Move the watermark to the newest loaded time. No rows, or older ones only, leave it where it is."""
    if newest is None:
        return current
    value = newest if current is None else max(current, newest)
    wh.append_log("watermarks", [(source, column, value, run_ts, "success")], WATERMARKS)
    return value
