from __future__ import annotations

import hashlib
from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martloom.functions import documents, hashing, headers, numbers, times
from martloom.session import workspace


def one(df):
    return df.first()[0]


@pytest.mark.parametrize(
    "raw, clean",
    [("out/in", "out_in"), ("  Room ID/id ", "room_id_id"), ("1st", "col_1st"), ("!!", "col_unnamed"), ("__a__b", "a_b"), ("Тemp", "emp")],
)
def test_clean_name(raw, clean):
    assert headers.clean_name(raw) == clean


def test_colliding_headers_are_an_error():
    with pytest.raises(ValueError, match="collide"):
        headers.clean_header(["a b", "a_b"])


def test_column_roles_take_the_first_candidate_and_must_all_be_there():
    roles = headers.column_roles(["time", "temp", "noted_date", "out_in"])
    assert roles == {"temperature": "temp", "date": "noted_date", "in_out": "out_in"}
    with pytest.raises(ValueError, match="in_out"):
        headers.column_roles(["temp", "date"])


def test_check_header_compares_cleaned_names_in_order():
    headers.check_header(["Out/In", "Temp"], ["out_in", "temp"])
    with pytest.raises(ValueError, match="mismatch"):
        headers.check_header(["temp", "out_in"], ["out_in", "temp"])


def test_amounts(spark):
    df = spark.createDataFrame([("4.5 g",), ("n/a",), ("",), (None,), ("-5",), ("1.005",)], "t string")
    got = [r[0] for r in df.select(numbers.amount(F.col("t"))).collect()]
    assert got == [Decimal("4.50"), None, None, None, Decimal("5.00"), Decimal("1.01")]


def test_a_comma_in_an_amount_raises_or_gives_null(spark):
    df = spark.createDataFrame([("4,5",)], "t string")
    assert one(df.select(numbers.amount(F.col("t"), strict=False))) is None
    with pytest.raises(PySparkException):
        df.select(numbers.amount(F.col("t"))).collect()


def test_day_first_dates_with_and_without_leading_zeros(spark):
    df = spark.createDataFrame([("08-12-2018 09:30",), ("8-12-2018 9:30",), (None,)], "t string")
    assert [r[0] for r in df.select(times.day_first_date(F.col("t"))).collect()] == [date(2018, 12, 8)] * 2 + [None]


def test_a_malformed_date_raises_or_gives_null(spark):
    df = spark.createDataFrame([("2018/12/08",)], "t string")
    assert one(df.select(times.day_first_date(F.col("t"), strict=False))) is None
    with pytest.raises(PySparkException):
        df.select(times.day_first_date(F.col("t"))).collect()


def test_elapsed_rounds_halves_away_from_zero_and_ignores_the_session_zone(spark):
    # The clocks of this zone change on this night.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [(datetime(2024, 3, 10, 1), datetime(2024, 3, 10, 4, 0, 0, 500000)), (datetime(2024, 1, 1, 0, 0, 1, 500000), datetime(2024, 1, 1))],
            "a timestamp_ntz, b timestamp_ntz",
        )
        got = df.select(times.elapsed_seconds(F.col("a"), F.col("b")), times.elapsed_hours(F.col("a"), F.col("b"))).collect()
        assert [tuple(r) for r in got] == [(10801, Decimal("3.00")), (-2, Decimal("0.00"))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_moment_does_not_depend_on_a_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark.range(1).select(times.moment(datetime(2024, 1, 2, 3, 4, 5, 678)))) == datetime(2024, 1, 2, 3, 4, 5, 678)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_documents_keep_nesting_and_microseconds(spark):
    df = spark.createDataFrame(
        [("k", datetime(2024, 1, 1, 9), [(datetime(2024, 1, 1, 9, 0, 0, 123456),)])], "_id string, t timestamp_ntz, m array<struct<at timestamp_ntz>>"
    )
    assert one(df.select(documents.to_document(df.columns))) == (
        '{"_id":"k","t":"2024-01-01T09:00:00.000000","m":[{"at":"2024-01-01T09:00:00.123456"}]}'
    )


def test_iso_text_drops_an_offset(spark):
    df = spark.createDataFrame([("2024-01-01T09:00:00+03:00",), ("2024-01-01T09:00:00",), ("2024-01-01T09:00:00.000Z",)], "t string")
    assert {r[0] for r in df.select(documents.iso_timestamp(F.col("t"))).collect()} == {datetime(2024, 1, 1, 9)}


def test_array_length_of_missing_and_null_arrays(spark):
    df = spark.createDataFrame([('{"a":[1,2]}',), ('{"a":null}',), ("{}",), ('{"a":[]}',)], "d string")
    parsed = df.select(documents.parse_document("d", "a ARRAY<INT>").alias("d"))
    assert [r[0] for r in parsed.select(documents.array_length(F.col("d.a"))).collect()] == [2, 0, 0, 0]


def test_sub_document_keeps_fields_no_schema_names(spark):
    df = spark.createDataFrame([('{"details":{"page":"/a","source":"banner"}}',)], "d string")
    assert one(df.select(documents.sub_document("d", "$.details"))) == '{"page":"/a","source":"banner"}'


def test_row_hash_reads_whole_numbers_and_nulls_as_text(spark):
    df = spark.createDataFrame([(None, "in", date(2018, 12, 8), 31.0)], "a string, b string, c date, d double")
    assert one(df.select(hashing.row_hash(df, df.columns))) == hashlib.md5(b"|in|2018-12-08|31").hexdigest()


def test_slices_are_in_range_and_stable(spark):
    df = spark.range(1000).select(hashing.hash_slice(F.col("id").cast("string"), 7).alias("s"))
    assert {r[0] for r in df.distinct().collect()} == set(range(7))
    assert one(spark.sql("select date'2024-03-09' d").select(hashing.month_slice("d"))) == 202403


def test_work_folders_need_a_shared_place_on_a_cluster(spark):
    stub = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace(stub, "x")
    assert workspace(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert workspace(spark, "x") != workspace(spark, "x")
