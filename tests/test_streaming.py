from __future__ import annotations

import json
from datetime import datetime

from martloom.plans.warehouse import SOURCES
from martloom.session import workspace
from martloom.sinks.topics import messages, publish
from martloom.sinks.warehouse import Warehouse
from martloom.sources.topics import decoded, message_files
from martloom.streaming.replicate import replicate
from martloom.streaming.upserts import merge_stream
from test_incremental import SESSION_DOC, pages, session, sessions

BODY = "station_id STRING, sensor_type STRING, value DOUBLE"


def write_messages(folder, name, records):
    folder.mkdir(exist_ok=True)
    lines = []
    for offset, value in records:
        lines.append(json.dumps({"key": "sensors", "value": value, "topic": "sensors", "partition": 0, "offset": offset, "timestamp": "2024-01-01T00:00:00"}))
    (folder / name).write_text("\n".join(lines) + "\n")


def test_three_messages_become_three_documents(spark, tmp_path, rows):
    body = [json.dumps({"station_id": f"st-{i}", "sensor_type": "wind", "value": i / 2, "more": i}) for i in range(3)]
    write_messages(tmp_path / "topic", "a.json", [(0, body[0]), (1, body[1])])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def drain():
        stream = message_files(spark, str(tmp_path / "topic"), stream=True, files_per_trigger=1)
        replicate(stream, BODY, out, checkpoint, once=True).awaitTermination()
        return spark.read.parquet(out)

    assert drain().count() == 2
    write_messages(tmp_path / "topic", "b.json", [(2, body[2])])
    drain()
    found = drain()
    assert rows(found, "_id", "station_id", "value", "_offset") == [(f"sensors-0-{i}", f"st-{i}", i / 2, i) for i in range(3)]
    batch = decoded(message_files(spark, str(tmp_path / "topic")), BODY)
    assert rows(found) == rows(batch)


def test_published_rows_are_keyed_by_a_column(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "station string, value double")
    publish(messages(df, "station", "sensors"), "json", str(tmp_path / "topic"))
    sent = spark.read.schema("key string, value string, topic string").json(str(tmp_path / "topic"))
    assert rows(sent) == [("a", '{"station":"a","value":1.5}', "sensors"), ("b", '{"station":"b"}', "sensors")]


def test_a_stream_of_batches_ends_as_one_batch_would(spark, tmp_path):
    wh = Warehouse.create(spark, workspace(spark, "stream"), 3)
    source = str(tmp_path / "source")
    run_ts = datetime(2024, 2, 1)

    def arrive(rows):
        spark.createDataFrame(rows, SESSION_DOC).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SESSION_DOC).option("maxFilesPerTrigger", 1).parquet(source)
        merge_stream(wh, SOURCES["user_sessions"], stream, str(tmp_path / "checkpoint"), once=True, clock=lambda: run_ts).awaitTermination()

    arrive([session("s1", 5, 50, ["new"]), session("s2", 1, 10)])
    arrive([session("s1", 2, 20, ["late", "x"]), session("s3", 9, 90, None)])
    found = {k: (r.session_duration_seconds, r.pages_visited_count) for k, r in sessions(wh).items()}
    assert found == {"s1": (50, 1), "s2": (10, 1), "s3": (90, 0)}
    assert pages(wh) == [("s1", 1, "new"), ("s2", 1, "a")]
    batches = wh.staging("user_sessions", SOURCES["user_sessions"].spec.staging_schema).select("batch_id").distinct()
    assert sorted(r[0] for r in batches.collect()) == ["user_sessions_stream_000000000000", "user_sessions_stream_000000000001"]


def test_replayed_and_late_batches_write_no_slice(spark, tmp_path):
    wh = Warehouse.create(spark, workspace(spark, "stream-state"), 3)
    source = str(tmp_path / "source")

    def arrive(rows):
        spark.createDataFrame(rows, SESSION_DOC).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SESSION_DOC).option("maxFilesPerTrigger", 1).parquet(source)
        merge_stream(wh, SOURCES["user_sessions"], stream, str(tmp_path / "checkpoint"), once=True, clock=lambda: datetime(2024, 2, 1)).awaitTermination()

    first = [session("s1", 5, 50), session("s2", 1, 10), session("s2", 1, 10)]
    arrive(first)
    committed, before = wh.snapshot().next_seq, sessions(wh)
    arrive(first)
    arrive([session("s1", 2, 20, ["late"]), session("s2", 0, 5)])
    assert wh.snapshot().next_seq == committed and sessions(wh) == before
    arrive([session("s2", 3, 30), session("s1", 5, 50)])
    assert wh.snapshot().next_seq == committed + 1
    assert {k: r.session_duration_seconds for k, r in sessions(wh).items()} == {"s1": 50, "s2": 30}
    staged = wh.staging("user_sessions", SOURCES["user_sessions"].spec.staging_schema)
    assert staged.count() == 3


def test_equal_times_and_null_times_end_as_in_one_batch(spark, tmp_path):
    source = str(tmp_path / "source")
    pairs = [session("s1", 5, 50, ["p"]), session("s1", 5, 60, ["q"])]
    outcomes = []
    for n, order in enumerate((pairs, pairs[::-1])):
        wh = Warehouse.create(spark, workspace(spark, "stream-ties"), 3)
        for row in order:
            spark.createDataFrame([row], SESSION_DOC).coalesce(1).write.mode("append").parquet(f"{source}-{n}")
            stream = spark.readStream.schema(SESSION_DOC).parquet(f"{source}-{n}")
            checkpoint = str(tmp_path / f"checkpoint-{n}")
            merge_stream(wh, SOURCES["user_sessions"], stream, checkpoint, once=True, clock=lambda: datetime(2024, 2, 1)).awaitTermination()
        outcomes.append(pages(wh))
    assert outcomes[0] == outcomes[1]


def test_messages_sent_again_are_stored_once(spark, tmp_path, rows):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    bodies = [json.dumps({"station_id": f"st-{i}", "sensor_type": "wind", "value": i / 2}) for i in range(4)]

    def drain():
        stream = message_files(spark, str(tmp_path / "topic"), stream=True, files_per_trigger=1)
        replicate(stream, BODY, out, checkpoint, once=True, within="1 hour", identity=["station_id", "_timestamp"]).awaitTermination()

    write_messages(tmp_path / "topic", "a.json", [(0, bodies[0]), (1, bodies[1]), (2, bodies[1])])
    drain()
    write_messages(tmp_path / "topic", "b.json", [(3, bodies[0]), (4, bodies[2])])
    write_messages(tmp_path / "topic", "c.json", [(5, bodies[2]), (6, bodies[3])])
    drain()
    assert rows(spark.read.parquet(out), "station_id") == [("st-0",), ("st-1",), ("st-2",), ("st-3",)]
