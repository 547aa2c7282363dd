from __future__ import annotations

import csv
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.operators.quality import QualityError
from martloom.plans import incremental, marts, temperature, warehouse
from martloom.plans.warehouse import SOURCES
from martloom.session import workspace
from martloom.sinks.runlog import JOB_LOG, WATERMARKS, current_watermarks, seed_watermarks, watermarks
from martloom.sinks.warehouse import Warehouse

SESSION_DOC = (
    "_id string, session_id string, user_id string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "pages_visited array<string>, device struct<type string, os string, browser string>, actions array<string>, batch_no int"
)
EVENT_DOC = "event_id string, timestamp timestamp_ntz, event_type string, details struct<page string, product_id string, source string>"
TICKET_DOC = (
    "ticket_id string, user_id string, status string, issue_type string, "
    "messages array<struct<sender string, message_text string, message_timestamp timestamp_ntz>>, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)
DAY = datetime(2024, 1, 1)
RUNS = [datetime(2024, 2, d) for d in range(1, 10)]


def at(hours: float) -> datetime:
    return DAY + timedelta(hours=hours)


def session(key, start, seconds=60.0, pages=("a",), actions=("x",), user="u1", device="mobile"):
    end = None if seconds is None else at(start) + timedelta(seconds=seconds)
    return (f"id-{key}", key, user, at(start), end, None if pages is None else list(pages), (device, "os", "br"), list(actions), 1)


def ticket(key, status, hours, messages=1):
    texts = [("user", f"m{i}", at(i)) for i in range(messages)]
    return (key, "u1", status, "login", texts, at(0), at(hours))


@pytest.fixture
def wh(spark):
    return Warehouse.create(spark, workspace(spark, "test"), 3)


@pytest.fixture
def load(spark, wh):
    def run(rows, run_ts, source="user_sessions", schema=SESSION_DOC, **options):
        return incremental.run(wh, {source: spark.createDataFrame(rows, schema)}, run_ts, **options)[source]

    return run


def sessions(wh):
    return {r.session_id: r for r in wh.read("dwh/user_sessions", warehouse.USER_SESSIONS).collect()}


def pages(wh):
    found = wh.read("dwh/session_pages", warehouse.SESSION_PAGES).orderBy("session_id", "page_order").collect()
    return [(r.session_id, r.page_order, r.page_url) for r in found]


def test_first_run_takes_everything_and_types_it(wh, load):
    counts = load([session("s1", 1, 90.5, ["a", "b"]), session("s2", 2, None, None, [])], RUNS[0])
    assert (counts.inserted, counts.updated, counts.rejected) == (2, 0, 0)
    found = sessions(wh)
    s1 = found["s1"]
    assert (s1.session_duration_seconds, s1.device_type, s1.pages_visited_count, s1.actions_count) == (91, "mobile", 2, 1)
    assert (s1.loaded_at, s1.updated_at) == (RUNS[0], RUNS[0])
    assert (found["s2"].end_time, found["s2"].session_duration_seconds, found["s2"].pages_visited_count) == (None, None, 0)
    assert pages(wh) == [("s1", 1, "a"), ("s1", 2, "b")]
    assert current_watermarks(wh)["user_sessions"] == at(2)


def test_newer_versions_update_and_older_ones_are_not_seen(wh, load):
    load([session("s1", 1, 10, ["a", "b", "c"]), session("s2", 2)], RUNS[0])
    counts = load([session("s1", 3, 20, ["z"]), session("s9", 1.5)], RUNS[1])
    assert (counts.inserted, counts.updated) == (0, 1)
    found = sessions(wh)
    assert set(found) == {"s1", "s2"}
    assert (found["s1"].session_duration_seconds, found["s1"].loaded_at, found["s1"].updated_at) == (20, RUNS[0], RUNS[1])
    assert found["s2"].updated_at == RUNS[0]
    assert pages(wh) == [("s1", 1, "z"), ("s2", 1, "a")]


def test_a_slice_whose_children_all_go_is_emptied(wh, load):
    load([session("s1", 1, 10, ["a", "b"])], RUNS[0])
    load([session("s1", 2, 10, None)], RUNS[1])
    assert pages(wh) == []
    assert sessions(wh)["s1"].pages_visited_count == 0


def test_nothing_new_changes_nothing(wh, load):
    rows = [session("s1", 1), session("s2", 2)]
    load(rows, RUNS[0])
    before = sessions(wh)
    counts = load(rows, RUNS[1])
    assert (counts.inserted, counts.updated) == (0, 0)
    assert sessions(wh) == before
    assert current_watermarks(wh)["user_sessions"] == at(2)


def test_a_lookback_sees_late_rows_but_keeps_newer_versions(wh, load):
    load([session("s1", 50, 10), session("s2", 60)], RUNS[0])
    load([session("s1", 49, 99), session("s3", 40)], RUNS[1], lookback_days=1)
    found = sessions(wh)
    assert set(found) == {"s1", "s2", "s3"}
    assert (found["s1"].session_duration_seconds, found["s1"].updated_at) == (10, RUNS[1])
    assert current_watermarks(wh)["user_sessions"] == at(60)


def test_two_versions_in_one_batch_and_a_null_time(wh, spark):
    source = SOURCES["user_sessions"]
    rows = [session("s1", 1, 10), session("s1", 2, 20)]
    incremental.stage(wh, source, spark.createDataFrame(rows, SESSION_DOC), "user_sessions_a", RUNS[0])
    incremental.merge(wh, source, "user_sessions_a", RUNS[0])
    assert sessions(wh)["s1"].session_duration_seconds == 20


def test_failed_checks_stop_the_watermark_and_the_next_run_repeats(wh, load):
    with pytest.raises(QualityError, match="user_sessions_negative_duration=1"):
        load([session("s1", 1, -30)], RUNS[0])
    assert current_watermarks(wh)["user_sessions"] is None
    load([session("s1", 2, 30)], RUNS[1])
    assert sessions(wh)["s1"].session_duration_seconds == 30
    assert current_watermarks(wh)["user_sessions"] == at(2)
    log = [(r.job_name, r.status) for r in wh.log("job_log", JOB_LOG).orderBy("started_at").collect()]
    assert log[:3] == [("extract", "success"), ("merge", "success"), ("quality", "failed")]
    assert log[3:] == [(j, "success") for j in ("extract", "merge", "quality", "watermark")]


def test_a_missing_required_value_fails_the_gate(load):
    with pytest.raises(QualityError, match="user_sessions_null_user_id=1"):
        load([session("s1", 1, user=None)], RUNS[0])


def test_events_without_a_type_are_rejected_and_leave_the_old_row(wh, load):
    first = [("e1", at(1), "click", ("/a", "7", "banner")), ("e2", at(1), "", None), ("e3", at(1), None, None)]
    counts = load(first, RUNS[0], "event_logs", EVENT_DOC)
    assert (counts.inserted, counts.rejected) == (1, 2)
    load([("e1", at(2), "", ("/b", "8", "x"))], RUNS[1], "event_logs", EVENT_DOC)
    # An older valid version that arrives late must not win over the rejected newer one.
    load([("e1", at(1.5), "view", ("/c", "9", "x")), ("e4", at(3), "view", None)], RUNS[2], "event_logs", EVENT_DOC, lookback_days=1)
    found = {r.event_id: r for r in wh.read("dwh/event_logs", warehouse.EVENT_LOGS).collect()}
    assert set(found) == {"e1", "e4"}
    e1 = found["e1"]
    assert (e1.event_type, e1.detail_page, e1.detail_product_id, e1.updated_at) == ("click", "/a", "7", RUNS[0])
    assert e1.source_details == '{"page":"/a","product_id":"7","source":"banner"}'


NINE = {
    "user_sessions_null_session_id", "user_sessions_negative_duration", "user_sessions_invalid_time_range",
    "event_logs_null_event_id", "event_logs_null_event_type", "support_tickets_null_ticket_id",
    "support_tickets_invalid_time_range", "support_tickets_negative_resolution", "support_tickets_null_status",
}


def test_three_sources_in_one_run(spark, wh):
    collections = {
        "user_sessions": spark.createDataFrame([session("s1", 1)], SESSION_DOC),
        "event_logs": spark.createDataFrame([("e1", at(2), "click", None), ("e2", at(2), "", None)], EVENT_DOC),
        "support_tickets": spark.createDataFrame([ticket("t1", "closed", 3)], TICKET_DOC),
    }
    counts = incremental.run(wh, collections, RUNS[0], run_id="run-1")
    assert {n: (c.inserted, c.rejected) for n, c in counts.items()} == {"user_sessions": (1, 0), "event_logs": (1, 1), "support_tickets": (1, 0)}
    assert current_watermarks(wh) == {"user_sessions": at(1), "event_logs": at(2), "support_tickets": at(3)}
    report = {r.check_name: r.error_count for r in incremental.quality_report(wh).collect()}
    assert NINE <= set(report) and set(report.values()) == {0}
    log = wh.log("job_log", JOB_LOG)
    assert {r.run_id for r in log.collect()} == {"run-1"}
    batches = {(r.job_name, r.batch_id) for r in log.where("source_name = 'event_logs'").collect()}
    stamp = "20240201T000000"
    assert batches == {("extract", f"event_logs_{stamp}"), ("merge", f"event_logs_merge_{stamp}"), ("watermark", f"event_logs_watermark_{stamp}")}


def test_tickets_and_their_messages(wh, load):
    load([ticket("t1", "open", 1, 3), ticket("t2", "resolved", 1.5, 1), ticket("t3", "odd", 2, 0), ticket("t4", None, 3)][:3], RUNS[0], "support_tickets", TICKET_DOC)
    load([ticket("t1", "closed", 10.005, 2)], RUNS[1], "support_tickets", TICKET_DOC)
    found = {r.ticket_id: r for r in wh.read("dwh/support_tickets", warehouse.SUPPORT_TICKETS).collect()}
    assert (found["t1"].resolution_time_hours, found["t1"].is_open, found["t1"].message_count) == (Decimal("10.01"), False, 2)
    assert (found["t2"].resolution_time_hours, found["t2"].is_open) == (Decimal("1.50"), False)
    assert (found["t3"].resolution_time_hours, found["t3"].is_open) == (None, False)
    messages = wh.read("dwh/ticket_messages", warehouse.TICKET_MESSAGES)
    listed = [(r.ticket_id, r.message_order, r.sender, r.message_text, r.message_timestamp) for r in messages.orderBy("ticket_id", "message_order").collect()]
    assert listed == [("t1", 1, "user", "m0", at(0)), ("t1", 2, "user", "m1", at(1)), ("t2", 1, "user", "m0", at(0))]


@pytest.mark.parametrize("cuts", [[], [2, 5, 9]])
def test_any_split_into_runs_gives_the_same_tables(spark, cuts):
    rows = [session(f"s{i % 4}", i, 10 * i, [f"p{n}" for n in range(i % 3)], device=f"d{i % 2}") for i in range(12)]
    wh = Warehouse.create(spark, workspace(spark, "split"), 3)
    seen, results = 0, None
    for run, cut in enumerate([*cuts, 12]):
        seen = cut
        incremental.run(wh, {"user_sessions": spark.createDataFrame(rows[:seen], SESSION_DOC)}, RUNS[run])
    results = [(r.session_id, r.session_duration_seconds, r.pages_visited_count, r.device_type) for r in sessions(wh).values()]
    assert sorted(results) == [("s0", 80, 2, "d0"), ("s1", 90, 0, "d1"), ("s2", 100, 1, "d0"), ("s3", 110, 2, "d1")]
    assert pages(wh) == [("s0", 1, "p0"), ("s0", 2, "p1"), ("s2", 1, "p0"), ("s3", 1, "p0"), ("s3", 2, "p1")]


def test_merging_a_batch_again_changes_only_the_stamp(wh, spark):
    source = SOURCES["user_sessions"]
    docs = spark.createDataFrame([session("s1", 1, 10, ["a"]), session("s2", 1)], SESSION_DOC)
    for _ in range(2):
        incremental.stage(wh, source, docs, "user_sessions_a", RUNS[0])
    assert wh.staging("user_sessions", source.spec.staging_schema).count() == 2
    incremental.merge(wh, source, "user_sessions_a", RUNS[0])
    before, before_pages = sessions(wh), pages(wh)
    counts = incremental.merge(wh, source, "user_sessions_a", RUNS[0])
    assert (counts.inserted, counts.updated) == (0, 2)
    assert (sessions(wh), pages(wh)) == (before, before_pages)


def test_an_uncommitted_version_is_not_visible(wh, load, spark):
    load([session("s1", 1, 10)], RUNS[0])
    rows = wh.read("dwh/user_sessions", warehouse.USER_SESSIONS).withColumn("device_type", F.lit("lost"))
    wh.write_version(rows, "dwh/user_sessions", "crashed", wh.key_slice("session_id"))
    assert sessions(wh)["s1"].device_type == "mobile"


def test_a_snapshot_keeps_its_state(wh, load):
    load([session("s1", 1, 10)], RUNS[0])
    before = wh.snapshot()
    load([session("s1", 2, 20)], RUNS[1])
    row = before.read("dwh/user_sessions", warehouse.USER_SESSIONS).first()
    assert row.session_duration_seconds == 10


def test_new_keys_add_to_a_slice_and_known_keys_replace_it(spark, wh, load):
    table, schema = "dwh/user_sessions", warehouse.USER_SESSIONS
    load([session("s1", 1, 10)], RUNS[0])
    load([session(f"n{i}", 2) for i in range(9)], RUNS[1])
    live = wh.snapshot().live[table]
    assert len(live) == 2 and sum(len(owned) for owned in live.values()) == 4
    january = (2024 * 12 + 1) * 3
    assert len(sessions(wh)) == 10
    before = sessions(wh)
    wh.compact(table, schema, RUNS[2])
    compacted = wh.snapshot().live[table]
    assert sum(len(owned) for owned in compacted.values()) == 3
    assert sessions(wh) == before
    load([session("s1", 5, 50), *[session(f"n{i}", 5) for i in range(9)]], RUNS[3])
    assert [sorted(owned) for owned in wh.snapshot().live[table].values()] == [[january + i for i in range(3)]]
    assert len(sessions(wh)) == 10


def test_the_slice_count_is_fixed(wh, spark):
    with pytest.raises(ValueError, match="3 slices"):
        Warehouse.create(spark, wh.root, 4)


def test_watermarks_are_seeded_once(wh):
    seed_watermarks(wh, {"a": "t", "b": "t"})
    seed_watermarks(wh, {"a": "t", "c": "t"})
    assert wh.log("watermarks", WATERMARKS).count() == 3
    assert {r.last_status for r in watermarks(wh).collect()} == {"never_run"}


def test_marts(wh, load, rows):
    load([session("s1", 1, 10, ["a", "b"], user="u1"), session("s2", 2, 11, user="u1", device="tablet"), session("s3", 3, None, user="u2", device=None)], RUNS[0])
    marts.build(wh, RUNS[0])
    mart = wh.read("mart/user_activity", marts.USER_ACTIVITY)
    assert rows(mart) == [
        ("u1", 2, Decimal("10.50"), 3, 2, at(2), "mobile", RUNS[0]),
        ("u2", 1, None, 1, 1, at(3), None, RUNS[0]),
    ]
    assert rows(marts.favorite_devices(mart)) == [("mobile", 1), (None, 1)]
    load([ticket("t1", "resolved", 3), ticket("t2", "open", 4)], RUNS[1], "support_tickets", TICKET_DOC)
    marts.build(wh, RUNS[1])
    support = wh.read("mart/support_efficiency", marts.SUPPORT_EFFICIENCY)
    assert rows(support, "ticket_id", "resolution_time_hours") == [("t1", Decimal("3.00")), ("t2", None)]
    assert rows(marts.status_distribution(support)) == [("open", 1), ("resolved", 1)]
    assert rows(marts.average_resolution(support)) == [("login", Decimal("3.00"))]


def test_the_joined_mart_is_the_same(spark, rows):
    df = spark.createDataFrame(
        [("u1", "a", 5, 1, 1, at(1)), ("u1", "b", 6, 2, None, at(2)), ("u1", "b", None, 2, 1, at(3)), ("u2", None, 7, 1, 1, at(4))],
        "user_id string, device_type string, session_duration_seconds int, pages_visited_count int, actions_count int, start_time timestamp_ntz",
    )
    columns = [f.split()[0] for f in marts.USER_ACTIVITY.split(", ")][:-1]
    assert rows(marts.user_activity(df), *columns) == rows(marts.user_activity_joined(df), *columns)


# ---- temperature -----------------------------------------------------------------------------------------


def write_csv(path, readings):
    with path.open("w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["id", "room_id/id", "noted_date", "temp", "out/in"])
        out.writerows([i, "Room", *r] for i, r in enumerate(readings))


def test_csv_to_extremes_and_target(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    readings = [(f"{d}-1-2024 9:30", str(20 + d), "In" if d % 2 else "in") for d in range(1, 22)]
    readings += [("05-01-2024 10:00", "25", "In"), ("06-01-2024 10:00", "99", "Out"), ("07-01-2024 10:00", "", "In")]
    write_csv(tmp_path / "in" / "a.csv", readings)
    root = str(tmp_path / "t")
    temperature.build_clean(spark, str(tmp_path / "in"), root)
    temperature.build_extremes(spark, root, n=2)
    assert spark.read.parquet(f"{root}/staging").columns == ["id", "room_id_id", "noted_date", "temp", "out_in"]
    clean = spark.read.schema(temperature.CLEAN).parquet(f"{root}/clean")
    # 22 values 21..41 with 25 twice: the bounds are 22.05 and 39.95.
    assert sorted({r.temp_c for r in clean.collect()}) == [float(t) for t in range(23, 40)]
    extremes = spark.read.parquet(f"{root}/extremes")
    assert rows(extremes, "kind", "rank_in_kind", "avg_temp_c") == [("coldest", 1, 23.0), ("coldest", 2, 24.0), ("hottest", 1, 39.0), ("hottest", 2, 38.0)]

    wh = Warehouse.create(spark, f"{root}/wh", 2)
    assert temperature.load_target(wh, clean.where("noted_date < date'2024-01-15'"), "incremental", RUNS[0]) == date(2024, 1, 14)
    assert wh.read("target", temperature.TARGET).count() == 12
    assert temperature.load_target(wh, clean, "incremental", RUNS[1]) == date(2024, 1, 19)
    stamps = {r.noted_date.day: r.load_dttm for r in wh.read("target", temperature.TARGET).collect()}
    assert stamps == {d: (RUNS[0] if d < 11 else RUNS[1]) for d in range(3, 20)}
    temperature.load_target(wh, clean.where("noted_date = date'2024-01-04'"), "full", RUNS[2])
    assert [(r.noted_date, r.load_dttm) for r in wh.read("target", temperature.TARGET).collect()] == [(date(2024, 1, 4), RUNS[2])]
    with pytest.raises(ValueError, match="neither"):
        temperature.load_target(wh, clean, "both", RUNS[3])


def test_optional_reading_columns_can_be_mapped(spark):
    raw = spark.createDataFrame([("d7", "1-1-2024 1:00", "3", "in")], "sensor string, noted_date string, temp string, out_in string")
    row = temperature.typed_readings(raw, optional={"device_id": "sensor"}).first()
    assert (row.device_id, row.room_id, row.noted_date, row.temp_c) == ("d7", None, date(2024, 1, 1), 3.0)


def test_unreadable_texts_are_counted(spark, rows):
    texts = [("x", "1", "in"), ("1-1-2024 1:00", "warm", "In"), ("1-1-2024 1:00", "", "in"), ("y", "z", "out"), (None, None, "in")]
    raw = spark.createDataFrame(texts, "noted_date string, temp string, out_in string")
    assert rows(temperature.reading_rejects(raw)) == [("readings_unreadable_noted_date", 1), ("readings_unreadable_temp_c", 1)]


def test_tolerant_typing_gives_null_for_bad_text(spark):
    raw = spark.createDataFrame([("x", "1", "in"), ("1-1-2024 1:00", "warm", "in")], "noted_date string, temp string, out_in string")
    assert [tuple(r)[-2:] for r in temperature.typed_readings(raw, strict=False).collect()] == [(None, 1.0), (date(2024, 1, 1), None)]


def test_what_is_made_of_a_winner_keeps_its_home(spark):
    docs = {"user_sessions": '{"pages_visited": ["a"], "actions": ["b"]}', "event_logs": "{}", "support_tickets": '{"messages": [{"sender": "x"}]}'}
    for name, source in SOURCES.items():
        raw = spark.createDataFrame([("k", docs[name], 7)], f"{source.key} string, source_doc string, home int")
        for made in (source.rows, *[child.rows for child in source.children]):
            assert [r.home for r in made(raw).collect()] == [7]
            assert "home" not in made(raw.drop("home")).columns
