"""Nested station files to two flat Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.operators.shred import flatten
from martloom.sinks.warehouse import overwrite
from martloom.sources.files import array_json, nested_json

STATION = (
    "station_id STRING, location STRING, datetime STRING, "
    "readings ARRAY<STRUCT<sensor_type: STRING, value: DOUBLE, unit: STRING, status: STRING>>, "
    "alerts ARRAY<STRUCT<level: STRING, code: STRING, message: STRING>>"
)
KEEP = ("station_id", "location", "datetime")


def readings(stations: DataFrame) -> DataFrame:
    return flatten(stations, "readings", KEEP, {f: f for f in ("sensor_type", "value", "unit", "status")})


def alerts(stations: DataFrame) -> DataFrame:
    return flatten(stations, "alerts", KEEP, {f: f"alert_{f}" for f in ("level", "code", "message")})


def flatten_stations(
    spark: SparkSession, source: str | list[str], readings_out: str, alerts_out: str, multiline: bool = True, split: bool = False
) -> None:
    """Two scans, each reading only the array it needs; no count or preview in between.

    ``split`` reads files that are one array of stations each by many tasks a file.
    """
    stations = array_json(spark, source, STATION) if split else nested_json(spark, source, STATION, multiline)
    overwrite(readings(stations), readings_out)
    overwrite(alerts(stations), alerts_out)
