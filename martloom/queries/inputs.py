"""The supplied tables in the shapes the jobs read. Every shape is built row by row, without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.queries.registry import table


LINE = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)


def text_time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def stations(spark: SparkSession, sf_dir: str, deal: str | None = None) -> DataFrame:
    """Order lines as stations: four measurements each, an alert for a high quantity and one for a high discount.

    With ``deal``, lines are dealt out by that expression over ``station_id``, whose value is kept as ``deal``: the narrow lines are
    shuffled, not the stations.
    """
    lines = table(spark, sf_dir, "lineitem")
    station = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("station_id")
    if deal is not None:
        lines = lines.select(*[c for c in lines.columns if c in LINE], station).withColumn("deal", F.expr(deal)).drop("station_id").repartition("deal")

    def reading(kind: str, column: str, unit: str, limit: float) -> Column:
        status = F.when(F.col(column) > limit, "warning").otherwise("ok")
        return F.struct(
            F.lit(kind).alias("sensor_type"), F.col(column).alias("value"), F.lit(unit).alias("unit"), status.alias("status")
        )

    def alert(level: str, code: str, message: str) -> Column:
        return F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"), F.lit(message).alias("message"))

    readings = F.array(
        reading("quantity", "l_quantity", "pcs", 40),
        reading("price", "l_extendedprice", "usd", 90000),
        reading("discount", "l_discount", "share", 0.08),
        reading("tax", "l_tax", "share", 0.07),
    )
    alerts = F.array_compact(
        F.array(
            F.when(F.col("l_quantity") > 40, alert("critical", "A003", "quantity above 40")),
            F.when(F.col("l_discount") > 0.08, alert("warning", "A002", "discount above 0.08")),
        )
    )
    return lines.select(
        station,
        F.col("l_returnflag").alias("location"),
        text_time("l_shipdate").alias("datetime"),
        readings.alias("readings"),
        alerts.alias("alerts"),
        *([] if deal is None else ["deal"]),
    )


def session_docs(spark: SparkSession, sf_dir: str, per_event: bool = False) -> DataFrame:
    """Events as session documents: one session per user and day, each event a newer version of it."""
    day = F.date_format("ts", "yyyy-MM-dd")
    key = F.col("event_id").cast("string") if per_event else F.concat_ws("-", "user_id", day)
    return table(spark, sf_dir, "events").select(
        key.alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))).alias("end_time"),
        F.regexp_extract_all("props", F.lit("([0-9])"), 1).alias("pages_visited"),
        F.struct(
            F.col("event_type").alias("type"),
            F.get_json_object("props", "$.k").alias("os"),
            F.lit(None).cast("string").alias("browser"),
        ).alias("device"),
        F.regexp_extract_all("event_type", F.lit("([aeiou])"), 1).alias("actions"),
    )


def event_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log documents, ``error`` events with a blank type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("event_type"),
        F.struct(
            F.col("event_type").alias("page"), F.get_json_object("props", "$.k").alias("product_id"), F.lit("props").alias("source")
        ).alias("details"),
    )


def ticket_docs(spark: SparkSession, sf_dir: str, key: str = "o_orderkey") -> DataFrame:
    """Orders as tickets: total price as seconds until the last update, priority words as messages."""
    status = F.when(F.col("o_orderstatus") == "F", "resolved").when(F.col("o_orderstatus") == "P", "in_progress").otherwise("open")
    messages = F.transform(
        F.split("o_orderpriority", "-"),
        lambda word, i: F.struct(
            F.when(i % 2 == 0, "user").otherwise("support").alias("sender"),
            word.alias("message_text"),
            F.col("o_orderdate").alias("message_timestamp"),
        ),
    )
    return table(spark, sf_dir, "orders").select(
        F.col(key).cast("string").alias("ticket_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        status.alias("status"),
        F.col("o_orderpriority").alias("issue_type"),
        messages.alias("messages"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_totalprice").cast("decimal(18,6)"))).alias("updated_at"),
    )


def temperature_text(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """Orders as raw temperature rows, all text: day-first dates, prices with blanks, mixed-case in/out."""
    place = F.when(F.col("o_orderstatus") == "O", "In").when(F.col("o_orderstatus") == "F", "in").otherwise("Out")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.date_format("o_orderdate", "d-M-yyyy H:m").alias("noted_date"),
        F.when(price < 50000, "").otherwise(price.cast("string")).alias("temp"),
        place.alias("out_in"),
        *keep,
    )


def day_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as clean readings: type as device, value as temperature."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("device_id"),
        F.lit(None).cast("string").alias("room_id"),
        F.lit(None).cast("string").alias("location"),
        F.lit("in").alias("outin"),
        F.to_date("ts").alias("noted_date"),
        F.col("value").alias("temp_c"),
    )
