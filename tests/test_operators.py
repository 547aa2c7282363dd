from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.operators.aggregates import distribution, mode, profile, rounded_avg, sum_or_zero
from martloom.operators.extremes import daily_average, extremes, in_report_order
from martloom.operators.hashload import full_rows, hashed, incremental_rows
from martloom.operators.latest import fold_latest, latest_version, newest_first
from martloom.operators.merge import ACTION, insert_ignore, replace_children, split_rejects, touch, upsert
from martloom.operators.outliers import percentiles, trim
from martloom.operators.quality import QualityError, Rule, all_checks, check, check_batch_size, check_parent, check_unique, gate, not_null, one_of
from martloom.operators.shape import equals_ignoring_case, required, with_defaults, with_nulls
from martloom.operators.shred import first_of_each, flatten, ordered_items

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


# ---- shape and shred -------------------------------------------------------------------------------------


def test_defaults_and_nulls_only_fill_missing_columns(spark):
    df = with_nulls(with_defaults(spark.range(1), {"id": 9, "n": 0}), {"n": "string", "note": "string"})
    assert df.dtypes == [("id", "bigint"), ("n", "int"), ("note", "string")]
    assert tuple(df.first()) == (0, 0, None)


def test_equality_without_case_does_not_trim(spark):
    df = spark.createDataFrame([("In",), ("in",), ("IN ",), (None,)], "p string")
    assert df.where(equals_ignoring_case(F.col("p"), "In")).count() == 2


def test_required(spark):
    with pytest.raises(Exception, match="p is required"):
        spark.createDataFrame([(None,)], "p string").select(required(F.col("p"), "p")).collect()


def test_flatten_and_ordered_items_skip_empty_arrays(spark, rows):
    df = spark.createDataFrame([(1, [("a", 1)]), (2, []), (3, None)], "id int, xs array<struct<k string, v int>>")
    assert rows(flatten(df, "xs", ["id"], {"v": "value"})) == [(1, 1)]
    names = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, xs array<string>")
    assert rows(ordered_items(names, "xs", ["id"], "n", "x")) == [(1, 1, "a"), (1, 2, "b")]


def test_first_of_each_treats_null_keys_as_equal(spark, rows):
    df = spark.createDataFrame([("a", None, 2, "x"), ("a", None, 1, "y"), ("b", "m", 5, "z")], "k string, m string, pos int, v string")
    assert rows(first_of_each(df, ["k", "m"], "pos"), "k", "m", "v") == [("a", None, "y"), ("b", "m", "z")]


# ---- latest ----------------------------------------------------------------------------------------------


def test_latest_version_order(spark, rows):
    df = spark.createDataFrame(
        [("a", T1, 1, "old"), ("a", T2, 1, "new"), ("b", T1, 1, "x"), ("b", T1, 2, "later"), ("c", T3, 9, "x"), ("c", None, 1, "open")],
        "k string, t timestamp_ntz, seq int, v string",
    )
    assert rows(latest_version(df, ["k"], newest_first("t", "seq")), "k", "v") == [("a", "new"), ("b", "later"), ("c", "open")]


def test_fold_latest_agrees_with_latest_version_and_marks_arrivals(spark, rows):
    schema = "k string, t timestamp_ntz, batch string, v string"
    known = spark.createDataFrame([("a", T2, "b1", "kept"), ("b", None, "b1", "open"), ("c", T1, "b1", "idle")], schema)
    arrived = spark.createDataFrame([("a", T1, "b2", "late"), ("b", T3, "b2", "x"), ("d", T1, "b2", "new"), ("d", T1, "b3", "newer")], schema)
    folded = fold_latest(known, arrived, "k", "t", ["batch"], "changed")
    assert rows(folded, "k", "v", "changed") == [("a", "kept", True), ("b", "open", True), ("c", "idle", False), ("d", "newer", True)]
    plain = latest_version(known.union(arrived), ["k"], newest_first("t", "batch"))
    assert rows(plain, "k", "v") == rows(folded, "k", "v")


# ---- merge -----------------------------------------------------------------------------------------------

TARGET = "k string, v int, extra string, loaded_at timestamp_ntz, updated_at timestamp_ntz"


def test_upsert_keeps_creation_moves_modification_and_tells_actions(spark, rows):
    target = spark.createDataFrame([("a", 1, "x", T1, T1), ("b", 2, "y", T1, T1)], TARGET)
    updates = spark.createDataFrame([("b", None), ("c", 3)], "k string, v int")
    merged = upsert(target, updates, ["k"], ["v"], T2, "loaded_at", "updated_at", with_action=True)
    assert rows(merged) == [("a", 1, "x", T1, T1, "keep"), ("b", None, "y", T1, T2, "update"), ("c", 3, None, T2, T2, "insert")]
    assert merged.columns[-1] == ACTION


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 9), max_size=6),
    updates=st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 9), max_size=6),
)
def test_upsert_twice_is_upsert_once(spark, target, updates):
    old = spark.createDataFrame(list(target.items()), "k string, v int")
    new = spark.createDataFrame(list(updates.items()), "k string, v int")
    once = upsert(old, new, ["k"], ["v"])
    twice = upsert(once, new, ["k"], ["v"])
    assert dict(map(tuple, once.collect())) == dict(map(tuple, twice.collect())) == {**target, **updates}


def test_insert_ignore_is_null_safe(spark, rows):
    target = spark.createDataFrame([("a", None, 1)], "k string, m string, v int")
    updates = spark.createDataFrame([("a", None, 2), ("b", None, 3), ("b", None, 3), ("a", "m", 4)], "k string, m string, v int")
    assert rows(insert_ignore(target, updates, ["k", "m"])) == [("a", "m", 4), ("a", None, 1), ("b", None, 3)]
    assert rows(insert_ignore(target, updates, ["k", "m"], only_new=True)) == [("a", "m", 4), ("b", None, 3)]


def test_touch_moves_only_the_stamp_of_known_rows(spark, rows):
    target = spark.createDataFrame([("h1", 1, T1), ("h2", 2, T1)], "h string, v int, at timestamp_ntz")
    fresh = spark.createDataFrame([("h2", 2), ("h3", 3)], "h string, v int")
    assert rows(touch(target, fresh, "h", "at", T2)) == [("h1", 1, T1), ("h2", 2, T2), ("h3", 3, T2)]


def test_replaced_children_can_shrink_to_none(spark, rows):
    target = spark.createDataFrame([("p", 1), ("p", 2), ("q", 1), ("r", 1)], "k string, n int")
    parents = spark.createDataFrame([("p",), ("q",), ("q",)], "k string")
    children = spark.createDataFrame([("p", 1)], "k string, n int")
    assert rows(replace_children(target, parents, children, "k")) == [("p", 1), ("r", 1)]


def test_split_rejects_loses_no_row(spark, rows):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    good, bad = split_rejects(df, F.col("v") > 0)
    assert rows(good) == [(1,)] and rows(bad) == [(-1,), (None,)]


# ---- percentiles -----------------------------------------------------------------------------------------


def cases():
    rng = np.random.default_rng(3)
    yield "few", [3.0, 1.0, 2.0]
    yield "one", [5.0]
    yield "equal", [7.5] * 50
    yield "many", rng.normal(20, 5, 60_000).tolist()
    yield "hot value", [1.25] * 30_000 + rng.uniform(0, 100, 30_000).tolist()
    yield "far apart", (10.0 ** rng.uniform(-200, 200, 40_000)).tolist()
    yield "two values", [0.0] * 20_000 + [1.0] * 20_001


@pytest.mark.parametrize("name, values", list(cases()), ids=[n for n, _ in cases()])
def test_percentiles_are_exact(spark, name, values):
    fractions = [0.5, 0.05, 0.95, 0.0, 1.0, 0.0501]
    df = spark.createDataFrame([(v,) for v in values + [None]], "v double").repartition(7)
    got = percentiles(df, "v", fractions)
    assert got == pytest.approx(np.percentile(values, [100 * f for f in fractions]).tolist(), rel=1e-12)


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert percentiles(df, "v", [0.5]) == [None]
    assert trim(df, "v").count() == 0


def test_trim_keeps_values_on_the_bounds(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)] + [(None,)], "v double")
    kept = sorted(r.v for r in trim(df, "v").collect())
    assert kept == [float(v) for v in range(5, 96)]


# ---- extremes --------------------------------------------------------------------------------------------


def test_extremes_break_ties_by_date_and_cope_with_short_years(spark):
    days = [(date(2024, 1, d), t) for d, t in [(1, 5.0), (2, 5.0), (3, 1.0), (4, 9.0), (5, 9.0), (6, 4.0), (7, 2.0)]] + [(date(2023, 5, 1), 3.0)]
    df = spark.createDataFrame(days + [(date(2024, 1, 3), 2.0)], "day date, t double")
    found = in_report_order(extremes(daily_average(df, "day", "t"), "day", n=3)).collect()
    listed = [(r.year, r.kind, r.rank_in_kind, r.day.day, r.avg_value) for r in found]
    assert listed == [
        (2023, "coldest", 1, 1, 3.0), (2023, "hottest", 1, 1, 3.0),
        (2024, "coldest", 1, 3, 1.5), (2024, "coldest", 2, 7, 2.0), (2024, "coldest", 3, 6, 4.0),
        (2024, "hottest", 1, 4, 9.0), (2024, "hottest", 2, 5, 9.0), (2024, "hottest", 3, 1, 5.0),
    ]


# ---- content hash load -----------------------------------------------------------------------------------

COLUMNS, REQUIRED = ["place", "day", "t"], ["day", "t"]


def test_equal_readings_share_a_hash_and_incomplete_ones_go(spark):
    df = spark.createDataFrame([("in", date(2024, 1, 1), 1.0)] * 3 + [("in", None, 1.0), ("in", date(2024, 1, 1), None)], "place string, day date, t double")
    assert hashed(df, COLUMNS, REQUIRED).distinct().count() == 1
    assert full_rows(df, COLUMNS, REQUIRED, T1).count() == 1


def test_incremental_hash_load_restamps_the_lookback_window(spark):
    df = spark.createDataFrame([("in", date(2024, 1, d), float(d)) for d in range(1, 11)], "place string, day date, t double")
    target = full_rows(df.where("day <= date'2024-01-08'"), COLUMNS, REQUIRED, T1)
    loaded = incremental_rows(target, df, COLUMNS, REQUIRED, "day", date(2024, 1, 8), T2)
    stamps = {r.day.day: r.load_dttm for r in loaded.collect()}
    assert stamps == {d: (T1 if d < 5 else T2) for d in range(1, 11)}
    first = incremental_rows(target.limit(0), df, COLUMNS, REQUIRED, "day", None, T1)
    assert first.count() == 10


# ---- aggregates ------------------------------------------------------------------------------------------


def test_mode_breaks_ties_by_value_with_null_last(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", None), ("b", None), ("b", None), ("b", "z"), ("c", "y"), ("c", "y"), ("c", "x")], "k string, v string")
    assert rows(mode(df, ["k"], "v", "m")) == [("a", "x"), ("b", None), ("c", "y")]


def test_averages_sums_profile_distribution(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", None)], "k string, v int")
    got = df.groupBy("k").agg(rounded_avg("v").alias("avg"), sum_or_zero("v").alias("sum"))
    assert rows(got) == [("a", Decimal("1.67"), 5), ("b", None, 0)]
    assert tuple(profile(df, "v").first()) == (4, 1, 2)
    assert rows(distribution(df, "k")) == [("a", 3), ("b", 1)]


# ---- quality ---------------------------------------------------------------------------------------------


def test_checks_and_gate(spark, rows):
    df = spark.createDataFrame([(1, "F"), (1, None), (None, "X")], "k int, s string")
    parents = spark.createDataFrame([(1,)], "id int")
    children = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    report = all_checks(
        [
            check(df, [*not_null("t", "k"), one_of("t", "s", ["F"]), Rule("t_none", F.col("k") > 5)]),
            check_unique(df, "t_duplicate_k", ["k"]),
            check_parent(children, parents, "t_orphan", "k", "id"),
        ]
    )
    assert rows(report) == [("t_duplicate_k", 1), ("t_invalid_s", 1), ("t_none", 0), ("t_null_k", 1), ("t_orphan", 2)]
    with pytest.raises(QualityError, match="5 errors: .*t_orphan=2"):
        gate(report)
    assert gate(report.where("error_count = 0")) == {"t_none": 0}


def test_batch_size():
    check_batch_size(3, 3)
    with pytest.raises(QualityError):
        check_batch_size(3, 2)
