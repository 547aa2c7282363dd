"""Bad input and competing writers."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom.functions.documents import parse_document
from martloom.functions.hashing import surrogate_id
from martloom.operators.merge import replace_children, upsert
from martloom.operators.outliers import percentiles
from martloom.plans import marts
from martloom.plans.payload_files import nutrition_foods, pet_records
from martloom.session import workspace
from martloom.sinks.runlog import JOB_LOG, RunLog
from martloom.sinks.warehouse import Warehouse
from martloom.sources.files import csv_text, nested_json

AT = datetime(2024, 1, 1)


def test_the_second_commit_of_one_number_fails(spark):
    wh = Warehouse.create(spark, workspace(spark, "writers"), 2)
    df = spark.range(10).select(F.col("id").cast("string").alias("k"))
    first, second = wh.snapshot(), wh.snapshot()
    for version, seen in (("a", first), ("b", second)):
        wh.write_version(df, "t", version, wh.key_slice("k"))
    wh.commit(first.next_seq, "a", ["t"], range(2), AT)
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        wh.commit(second.next_seq, "b", ["t"], range(2), AT)
    assert wh.read("t", "k string").count() == 10
    assert wh.snapshot().next_seq == first.next_seq + 1


def test_null_keys_are_merged_once(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    once = upsert(rows, rows.withColumn("v", F.col("v") + 1), ["k"], ["v"])
    assert sorted(map(tuple, once.collect()), key=repr) == [("a", 3), (None, 2)]
    left = replace_children(rows, rows.where("k IS NULL"), rows.where("k IS NULL").withColumn("v", F.lit(9)), "k")
    assert sorted(map(tuple, left.collect()), key=repr) == [("a", 2), (None, 9)]


def test_a_long_error_is_logged_whole(spark):
    wh = Warehouse.create(spark, workspace(spark, "log"), 2)
    log = RunLog(wh)
    with pytest.raises(ValueError), log.step("job"):
        raise ValueError("x" * 5000)
    log.flush()
    assert wh.log("job_log", JOB_LOG).first().error_message == "x" * 5000


def test_marts_are_built_by_name(spark):
    wh = Warehouse.create(spark, workspace(spark, "marts"), 2)
    marts.build(wh, AT, ["user_activity"])
    assert [r.source_name for r in wh.log("job_log", JOB_LOG).collect()] == ["user_activity"]
    with pytest.raises(ValueError, match="no such mart"):
        marts.build(wh, AT, ["other"])


@pytest.mark.parametrize("payload", ['{"pets":[{"name":"a"}', '{"pets":"none"}', "{bad"])
def test_broken_json_payloads_fail_a_strict_load(spark, payload):
    landed = spark.createDataFrame([("1", payload), ("2", '{"pets":[{"name":"b"}]}')], "raw_id string, payload string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        pet_records(landed).collect()
    assert [r["name"] for r in pet_records(landed.where("raw_id = '2'"), strict=False).collect()] == ["b"]


def test_broken_xml_fails_a_strict_load(spark):
    landed = spark.createDataFrame([("1", "<nutrition><food><name>a</name>")], "raw_id string, payload string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        nutrition_foods(landed).collect()


def test_broken_documents_fail(spark):
    docs = spark.createDataFrame([("{bad",)], "d string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        docs.select(parse_document("d", "a INT")).collect()


@pytest.mark.parametrize("row", ["1,2", "1,2,3,4"])
def test_ragged_csv_fails_a_strict_read(spark, tmp_path, row):
    (tmp_path / "x.csv").write_text(f"a,b,c\n1,2,3\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        csv_text(spark, str(tmp_path)).collect()
    assert csv_text(spark, str(tmp_path), strict=False).count() == 2


def test_quoted_line_breaks_are_read_with_multiline(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n')
    assert [tuple(r) for r in csv_text(spark, str(tmp_path), multiline=True).collect()] == [("1", "two\nlines")]


def test_broken_json_lines_fail_a_strict_read(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n{"a": "text"}\n')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        nested_json(spark, str(tmp_path), "a INT", multiline=False).collect()


def test_ids_tell_lists_of_parts_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None), (None, "a"), ("-", None)], "x string, y string")
    ids = [r[0] for r in df.select(surrogate_id("x", "y")).collect()]
    assert len(set(ids)) == 5 and all(len(i) == 32 for i in ids)


@pytest.mark.parametrize("n", [1, 2, 3, 50, 25_000])
def test_percentiles_take_one_path_at_every_size(spark, n):
    df = spark.range(n).select((F.col("id") * 1.0).alias("v")).union(spark.createDataFrame([(1e12,), (None,)], "v double"))
    values = [*map(float, range(n)), 1e12]
    for p, got in zip((0, 0.05, 0.5, 0.95, 1), percentiles(df, "v", [0, 0.05, 0.5, 0.95, 1]), strict=True):
        spot = p * n
        low, high = values[int(spot)], values[min(int(spot) + 1, n)]
        assert abs(got - (low + (spot - int(spot)) * (high - low))) <= 1e-9 * max(1, abs(got))
