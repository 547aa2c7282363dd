"""What the physical plans must and must not contain."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom.functions.documents import to_document
from martloom.operators.latest import latest_version, newest_first
from martloom.operators.merge import replace_children
from martloom.operators.quality import check
from martloom.operators.shred import flatten
from martloom.plans import marts, stations, warehouse
from martloom.queries import REGISTRY
from martloom.session import workspace
from martloom.sinks.warehouse import Warehouse
from martloom.sources.documents import since
from martloom.sources.files import nested_json

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Queries that run whole jobs and only read a result back.
JOBS = {name for name in REGISTRY if name.startswith(("gated_", "run_log", "stream_", "target_", "csv_to_", "stations_to", "watermark_", "staging_"))}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables absent")
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark):
    for name in sorted(set(REGISTRY) - JOBS):
        text = plan(REGISTRY[name].build(spark, SF_DIR))
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert node not in text, (name, node)


def test_the_watermark_reaches_the_file_scan(spark, tmp_path):
    spark.sql("select timestamp_ntz'2024-01-01' t, 1 v").write.parquet(str(tmp_path / "t"))
    text = plan(since(spark.read.parquet(str(tmp_path / "t")), "t", datetime(2024, 1, 1)))
    assert "PushedFilters: [IsNotNull(t), GreaterThan(t,2024-01-01T00:00)]" in text


def test_latest_version_cuts_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1), 1)], "k string, t timestamp_ntz, n int")
    text = plan(latest_version(df, ["k"], newest_first("t", "n")))
    assert "row_number(), 1, Partial" in text and text.count("Exchange") == 1


def test_documents_are_parsed_once_even_under_a_filter(spark):
    df = spark.createDataFrame([("a", '{"event_type":"x"}')], "event_id string, source_doc string")
    rows = warehouse.events(df).where(F.col("event_type").isNotNull())
    assert plan(rows).count("from_json(") == 1
    tickets = spark.createDataFrame([("a", "{}")], "ticket_id string, source_doc string")
    assert plan(warehouse.ticket_messages(tickets)).count("from_json(") == 1


def test_a_child_table_reads_only_its_array(spark, tmp_path):
    (tmp_path / "s.json").write_text("[]")
    text = plan(stations.alerts(nested_json(spark, str(tmp_path / "s.json"), stations.STATION)))
    assert "readings" not in text.split("ReadSchema")[1]
    spark.createDataFrame([], stations.STATION).write.parquet(str(tmp_path / "p"))
    stored = spark.read.schema(stations.STATION).parquet(str(tmp_path / "p"))
    scan = plan(flatten(stored, "alerts", ["station_id"], {"code": "code"})).split("ReadSchema")[1]
    assert "code" in scan and "message" not in scan and "location" not in scan


def test_all_rules_of_a_table_take_one_scan(spark, tmp_path):
    spark.createDataFrame([], warehouse.SUPPORT_TICKETS).write.parquet(str(tmp_path / "t"))
    df = spark.read.schema(warehouse.SUPPORT_TICKETS).parquet(str(tmp_path / "t"))
    assert plan(check(df, warehouse.ticket_rules())).count("FileScan") == 1


def test_the_activity_mart_takes_one_scan_and_no_join(spark, tmp_path):
    spark.createDataFrame([], warehouse.USER_SESSIONS).write.parquet(str(tmp_path / "t"))
    text = plan(marts.user_activity(spark.read.schema(warehouse.USER_SESSIONS).parquet(str(tmp_path / "t"))))
    assert text.count("FileScan") == 1 and "Join" not in text and text.count("Exchange") == 2


def test_only_the_wanted_slices_are_read(spark):
    wh = Warehouse.create(spark, workspace(spark, "prune"), 8)
    schema = "k string, v int"
    df = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    wh.write_version(df, "t", "v1", wh.key_slice("k"))
    wh.commit(1, "v1", ["t"], range(8), datetime(2024, 1, 1))
    part = wh.read("t", schema, [3])
    assert "PartitionFilters: [isnotnull(version" in plan(part) or "PartitionFilters: [(version" in plan(part)
    files = [r[0] for r in part.select(F.input_file_name()).distinct().collect()]
    assert {path.split("slice=")[1].split("/")[0] for path in files} == {"3"}
    assert {r[0] for r in part.select(wh.key_slice("k")).distinct().collect()} == {3}
    assert wh.read("t", schema).count() == 200


def test_a_hot_key_is_folded_before_the_shuffle(spark):
    """A third of all rows on one key: each map task cuts its rows down to one per key before the shuffle."""
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("t"),
        F.col("id").alias("n"),
    )
    latest = latest_version(df, ["k"], newest_first("t", "n"))
    text = plan(latest)
    assert text.index("WindowGroupLimit", text.index("Exchange")) > 0 and "Partial" in text[text.index("Exchange") :]
    assert latest.where("k = 'hot'").first().n == 29_997
    assert latest.count() == 20_001


def test_a_huge_child_list_survives_replacement(spark):
    """One parent with a third of all children is written, replaced and counted in full."""
    wh = Warehouse.create(spark, workspace(spark, "hot"), 4)
    docs = spark.range(0, 3).select(
        F.concat(F.lit("s"), "id").alias("session_id"),
        F.struct(
            F.lit("2024-01-01T00:00:00").alias("start_time"),
            F.transform(F.sequence(F.lit(1), F.when(F.col("id") == 0, 20_000).otherwise(100)), lambda i: i.cast("string")).alias("pages_visited"),
        ).alias("doc"),
    )
    raw = docs.select("session_id", to_document(["doc.*"]).alias("source_doc"))
    pages = warehouse.session_pages(raw)
    assert pages.count() == 20_200
    wh.write_version(pages, "p", "v1", wh.key_slice("session_id"))
    wh.commit(1, "v1", ["p"], range(4), datetime(2024, 1, 1))
    read = wh.read("p", "session_id string, page_order int, page_url string")
    changed = spark.createDataFrame([("s0",)], "session_id string")
    replaced = replace_children(read, changed, pages.where("session_id = 's0' AND page_order <= 15000"), "session_id")
    counts = {r["session_id"]: r["n"] for r in replaced.groupBy("session_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {"s0": 15_000, "s1": 100, "s2": 100}
