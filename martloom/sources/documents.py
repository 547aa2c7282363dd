"""Document collections: what identifies a source, and reading only what is new."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.documents import to_document
from martloom.functions.hashing import surrogate_id
from martloom.functions.times import lookback_start, moment


@dataclass(frozen=True)
class SourceSpec:
    """A collection: its business key, the field that tells new from old, and where it is staged."""

    name: str
    key: str
    watermark_field: str
    staged_field: str

    @property
    def staging_schema(self) -> str:
        return (
            f"id STRING, {self.key} STRING, source_doc STRING, {self.staged_field} TIMESTAMP_NTZ, "
            "extracted_at TIMESTAMP_NTZ, batch_id STRING"
        )


def documents(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """A collection through whatever connector the cluster carries (``mongodb``, ``jdbc``, ``parquet`` ...)."""
    return spark.read.format(fmt).options(**options).load()


def since(df: DataFrame, column: str, watermark: date | datetime | None, lookback_days: int | None = None) -> DataFrame:
    """Rows after the watermark, or all of them when there is none yet.

    Strictly after by default. With a lookback, from that many days before the watermark on, inclusive:
    late rows are seen again, which is safe before an idempotent merge. The bound is a literal, so it
    reaches the source as a pushed filter.
    """
    if watermark is None:
        return df
    if lookback_days is None:
        return df.where(F.col(column) > moment(watermark))
    return df.where(F.col(column) >= moment(lookback_start(watermark, lookback_days)))


def raw_rows(docs: DataFrame, spec: SourceSpec) -> DataFrame:
    """Key, the whole document as JSON, watermark copy and an id of their content."""
    rows = docs.select(
        F.col(spec.key).cast("string").alias(spec.key),
        to_document([text_id(docs, c) for c in docs.columns]).alias("source_doc"),
        F.col(spec.watermark_field).cast("timestamp_ntz").alias(spec.staged_field),
    )
    return rows.withColumn("id", surrogate_id(spec.key, spec.staged_field, "source_doc"))


def with_provenance(rows: DataFrame, batch_id: str, run_ts: datetime) -> DataFrame:
    return rows.withColumns({"extracted_at": moment(run_ts), "batch_id": F.lit(batch_id)})


def staged(docs: DataFrame, spec: SourceSpec, batch_id: str, run_ts: datetime) -> DataFrame:
    """Raw rows for staging: key, the whole document as JSON, watermark copy and provenance."""
    return with_provenance(raw_rows(docs, spec), batch_id, run_ts)


def text_id(docs: DataFrame, column: str) -> Column:
    """Document ids are stored as text, all else as it is."""
    return F.col(column).cast("string").alias(column) if column == "_id" else F.col(column)


def batch_name(source: str, run_ts: datetime, step: str = "") -> str:
    """``orders_20240101T090000``, or ``orders_merge_20240101T090000`` with a step: sorts by time."""
    parts: Sequence[str] = [source, step, run_ts.strftime("%Y%m%dT%H%M%S")]
    return "_".join(p for p in parts if p)
