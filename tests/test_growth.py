"""What a run reads and rewrites as history grows: homes of keys, marts kept up by changes, a target that shrinks."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators import sliced_percentiles
from martloom.operators.shape import with_nulls
from martloom.operators.sliced_percentiles import percentiles_of_slices, sketches
from martloom.plans import incremental, marts, temperature, warehouse
from martloom.plans.temperature import newest_date
from martloom.session import workspace
from martloom.sinks.warehouse import Warehouse, append_batch
from test_incremental import RUNS, SESSION_DOC, TICKET_DOC, session, ticket

TABLES = ("latest/user_sessions", "dwh/user_sessions", "dwh/session_pages", "dwh/session_actions")


@pytest.fixture
def wh(spark):
    return Warehouse.create(spark, workspace(spark, "growth"), 2)


def load(spark, wh, rows, run_ts):
    return incremental.run(wh, {"user_sessions": spark.createDataFrame(rows, SESSION_DOC)}, run_ts, lookback_days=4000)


def in_month(key, month, **more):
    made = session(key, 0, **more)
    start = datetime(2024, month, 3)
    return (*made[:3], start, start + timedelta(seconds=60), *made[5:])


def owners(wh, table):
    """Version of every slice."""
    return {s: version for version, owned in wh.snapshot().live[table].items() for s in owned}


def test_updates_of_one_month_leave_other_months_alone(spark, wh):
    load(spark, wh, [in_month(f"k{m}-{i}", m) for m in range(1, 7) for i in range(4)], RUNS[0])
    before = {t: owners(wh, t) for t in TABLES}
    changed = [in_month(f"k2-{i}", 2, pages=("b", "c")) for i in range(4)] + [in_month("new", 5)]
    counts = load(spark, wh, changed, RUNS[1])["user_sessions"]
    assert (counts.inserted, counts.updated) == (1, 4)
    for table in TABLES:
        after = owners(wh, table)
        moved = {s // 2 - 2024 * 12 for s, version in before[table].items() if after[s] != version}
        # The new key of May is added to a slice, which keeps what it had.
        assert moved <= {2, 5} and 2 in moved
        assert {v for v in wh.snapshot().live[table] if v in before[table].values()}
    rows = wh.read("dwh/user_sessions", warehouse.USER_SESSIONS)
    assert rows.count() == 25 == rows.select("session_id").distinct().count()
    assert wh.read("dwh/session_pages", warehouse.SESSION_PAGES).count() == 29


def test_a_key_stays_at_home_when_its_time_moves(spark, wh):
    load(spark, wh, [in_month("a", 1)], RUNS[0])
    load(spark, wh, [in_month("a", 6, pages=("x", "y"))], RUNS[1])
    assert {s // 2 - 2024 * 12 for s in owners(wh, "dwh/user_sessions")} == {1}
    assert wh.read("dwh/user_sessions", warehouse.USER_SESSIONS).first().pages_visited_count == 2
    assert wh.read("keys/user_sessions", incremental.DIRECTORY).count() == 1


def activity(wh):
    return sorted((tuple(r) for r in wh.read("mart/user_activity", marts.USER_ACTIVITY).drop("updated_at").collect()), key=repr)


def recomputed(wh):
    return sorted((tuple(r) for r in marts.user_activity(wh.read("dwh/user_sessions", warehouse.USER_SESSIONS)).collect()), key=repr)


def test_a_refreshed_mart_equals_the_recomputed_one(spark, wh):
    load(spark, wh, [in_month(f"s{m}{u}", m, user=u, device=d) for m in range(1, 5) for u, d in (("u1", "mobile"), ("u2", "tablet"), ("u3", None))], RUNS[0])
    marts.refresh(wh, RUNS[0])
    assert activity(wh) == recomputed(wh)
    changes = [
        [in_month("s1u1", 1, user="u1", device="tablet"), in_month("new", 2, user="u4", device="desktop")],  # another device, a new user
        [in_month("s2u2", 2, user="u1", device="mobile")],  # another user
        [in_month("s4u1", 4, user="u1", device="desktop"), in_month("s4u3", 4, user="u3", device="mobile")],  # the newest of a group goes
    ]
    for run_ts, rows in zip(RUNS[1:], changes):
        load(spark, wh, rows, run_ts)
        marts.refresh(wh, run_ts)
        assert activity(wh) == recomputed(wh)
    stamps = {r.user_id: r.updated_at for r in wh.read("mart/user_activity", marts.USER_ACTIVITY).collect()}
    assert stamps == {"u1": RUNS[3], "u2": RUNS[2], "u3": RUNS[3], "u4": RUNS[1]}
    before = wh.snapshot().next_seq
    marts.refresh(wh, RUNS[5])
    assert wh.snapshot().next_seq == before


def test_refreshed_tickets_are_those_of_the_table(spark, wh):
    for run_ts, rows in ((RUNS[0], [ticket("t1", "open", 1), ticket("t2", "open", 1)]), (RUNS[1], [ticket("t1", "closed", 9), ticket("t3", "open", 5)])):
        incremental.run(wh, {"support_tickets": spark.createDataFrame(rows, TICKET_DOC)}, run_ts)
        marts.refresh(wh, run_ts, ["support_efficiency"])
        mart = wh.read("mart/support_efficiency", marts.SUPPORT_EFFICIENCY)
        assert sorted(mart.collect()) == sorted(marts.support_efficiency(wh.read("dwh/support_tickets", warehouse.SUPPORT_TICKETS)).collect())


def test_the_newest_date_of_a_target_that_shrank(spark, wh):
    days = spark.createDataFrame([("a", datetime(2024, 1, 5).date()), ("b", datetime(2024, 2, 7).date())], "row_hash string, noted_date date")
    wh.write_version(days, "target", "v1", F.month("noted_date"))
    wh.commit(1, "v1", ["target"], [1, 2], RUNS[0])
    assert newest_date(wh.snapshot()) == datetime(2024, 2, 7).date()
    wh.write_version(days.where("row_hash = 'a'"), "target", "v2", F.month("noted_date"))
    wh.commit(2, "v2", ["target"], [1, 2], RUNS[1])
    assert newest_date(wh.snapshot()) == datetime(2024, 1, 5).date()


# ---- percentiles of a layer that grows ----------------------------------------------------------------------


def sliced_values():
    rng = np.random.default_rng(5)
    hot = [1.25] * 20_000 + rng.uniform(0, 100, 20_000).tolist()
    yield "five", [4.0, 1.0, 3.0, 2.0, 5.0], [0.3, 0.05, 0.95]
    yield "one", [5.0], [0.3]
    yield "equal", [7.5] * 300, [0.05, 0.95]
    yield "gap in the middle", hot, [0.05, 0.95]
    yield "gap above", hot, [0.3]
    yield "gap below", hot, [1.0, 0.9501, 0.95]
    yield "far apart", (10.0 ** rng.uniform(-200, 200, 40_000)).tolist(), [0.05, 0.5, 0.95, 0.0]
    yield "infinite", [float("inf")] * 50 + rng.normal(0, 1, 5_000).tolist(), [0.9, 0.95]


@pytest.mark.parametrize("name, values, fractions", list(sliced_values()), ids=[name for name, *_ in sliced_values()])
def test_percentiles_of_slices_are_exact(spark, name, values, fractions):
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)] + [(3, None)], "s int, v double").repartition(5)
    # A slice's sketch may come in several rows.
    state = sketches(df.where("s < 4"), "v", F.col("s")).unionByName(sketches(df.where("s >= 4"), "v", F.lit("0")))
    got = percentiles_of_slices(df, "v", state, fractions)
    assert got == pytest.approx(np.percentile(values, [100 * f for f in fractions]).tolist(), rel=1e-12)


def test_nan_is_the_greatest_value_and_nothing_has_no_percentile(spark):
    df = spark.createDataFrame([(float(v),) for v in range(90)] + [(float("nan"),)] * 11, "v double")
    got = percentiles_of_slices(df, "v", sketches(df, "v", F.lit("a")), [0.5, 0.89, 0.9, 1.0])
    assert got[:2] == [50.0, 89.0] and all(v != v for v in got[2:])
    only = df.where(F.isnan("v"))
    assert all(v != v for v in percentiles_of_slices(only, "v", sketches(only, "v", F.lit("a")), [0.0, 0.4]))
    none = df.where("v < 0")
    assert percentiles_of_slices(none, "v", sketches(none, "v", F.lit("a")), [0.4]) == [None]


def test_a_range_that_missed_is_made_wider(spark, monkeypatch):
    monkeypatch.setattr(sliced_percentiles, "K", 8)
    values = np.random.default_rng(2).normal(0, 1, 3_000).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    monkeypatch.setattr(sliced_percentiles, "MARGIN", 0.0001)
    got = percentiles_of_slices(df, "v", sketches(df, "v", F.lit("a")), [0.1, 0.5])
    assert got == pytest.approx(np.percentile(values, [10, 50]).tolist(), rel=1e-12)


def test_sketches_of_fewer_rows_are_refused(spark):
    df = spark.createDataFrame([(float(v),) for v in range(100)], "v double")
    with pytest.raises(RuntimeError, match="sketches"):
        percentiles_of_slices(df, "v", sketches(df.where("v < 20"), "v", F.lit("a")), [0.05, 0.95])


def test_a_day_is_added_without_reading_older_ones(spark, tmp_path, rows):
    days = [[(date(2024, 1, d), float(100 * d + i)) for i in range(40)] for d in (1, 2, 3)]
    frames = [spark.createDataFrame(day, "noted_date date, temp_c double") for day in days]
    frames = [with_nulls(frame.withColumn("outin", F.lit("in")), temperature.OPTIONAL) for frame in frames]
    root = str(tmp_path)
    for d, frame in enumerate(frames[:2]):
        temperature.add_readings(spark, frame, root, f"day-{d}")
    kept = tmp_path / "typed_batches" / "batch_id=day-0"
    whole = {file: file.read_bytes() for file in kept.glob("*.parquet")}
    for file in [*whole, *kept.glob(".*.crc")]:
        file.write_bytes(b"not readable")
    temperature.add_readings(spark, frames[2], root, "day-2")
    for file, content in whole.items():
        file.write_bytes(content)
    for file in kept.glob(".*.crc"):
        file.unlink()
    everything = reduce(DataFrame.unionByName, frames).select(*temperature.CLEAN_COLUMNS)
    assert rows(temperature.grown_clean_layer(spark, root)) == rows(temperature.clean_layer(everything))
    # Written again, a batch replaces itself; without its sketches it does not count.
    temperature.add_readings(spark, frames[2], root, "day-2")
    append_batch(frames[0].select(*temperature.CLEAN_COLUMNS, F.lit("day-9").alias("batch_id")), f"{root}/typed_batches")
    assert rows(temperature.grown_clean_layer(spark, root)) == rows(temperature.clean_layer(everything))
