from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martloom.operators.latest import latest_payload, latest_payloads
from martloom.plans import payload_files, stations
from martloom.queries import REGISTRY, inputs
from martloom.session import setting
from martloom.sinks.warehouse import append_batch, overwrite
from martloom.sources import files, topics
from martloom.sources.documents import SourceSpec, batch_name, documents, since, staged

KINDS = [("temperature", "C"), ("humidity", "%"), ("pressure", "hPa"), ("wind", "m/s")]


def station_docs():
    """Five stations with four readings each and 1, 2, 2, 1, 2 alerts; one reading and one alert critical."""
    docs = []
    for i, alerts in enumerate([1, 2, 2, 1, 2]):
        readings = [{"sensor_type": k, "value": i * 10 + j / 2, "unit": u, "status": "ok"} for j, (k, u) in enumerate(KINDS)]
        messages = [{"level": "info", "code": f"C{n}", "message": f"note {n}"} for n in range(alerts)]
        docs.append({"station_id": f"st-{i}", "location": f"City {i}", "datetime": "2024-11-10 06:00:00", "readings": readings, "alerts": messages})
    docs[2]["readings"][3]["status"] = "critical"
    docs[2]["alerts"][0]["level"] = "critical"
    return docs


def test_station_files_become_two_flat_tables(spark, tmp_path, rows):
    docs = station_docs() + [{"station_id": "bare", "location": "x", "datetime": "t", "alerts": []}]
    (tmp_path / "in.json").write_text(json.dumps(docs, indent=2))
    stations.flatten_stations(spark, str(tmp_path / "in.json"), str(tmp_path / "r"), str(tmp_path / "a"))
    stations.flatten_stations(spark, str(tmp_path / "in.json"), str(tmp_path / "r2"), str(tmp_path / "a2"), split=True)
    for name in ("r", "a"):
        assert rows(spark.read.parquet(str(tmp_path / f"{name}2"))) == rows(spark.read.parquet(str(tmp_path / name)))
    readings, alerts = spark.read.parquet(str(tmp_path / "r")), spark.read.parquet(str(tmp_path / "a"))
    assert (readings.count(), alerts.count()) == (20, 8)
    assert readings.columns == ["station_id", "location", "datetime", "sensor_type", "value", "unit", "status"]
    assert alerts.columns == ["station_id", "location", "datetime", "alert_level", "alert_code", "alert_message"]
    assert rows(readings.where("status = 'critical'"), "station_id", "sensor_type", "value") == [("st-2", "wind", 21.5)]
    assert alerts.where("alert_level = 'critical'").count() == 1


def test_landed_json_becomes_pets_and_foods(spark, tmp_path, rows):
    pets = [
        {"name": "Ada", "species": "Cat", "favFoods": ["fish", "<b>any</b> food", "fish"], "birthYear": 2016, "photo": "p1"},
        {"name": "Bo", "species": "Dog", "birthYear": 2008, "photo": "p2"},
        {"name": "Cy", "species": "Cat", "favFoods": ["tuna", "celery"], "birthYear": 2012, "photo": None},
        {"name": "Ada", "species": "Fox", "favFoods": ["mice"], "birthYear": 1, "photo": None},
        {"name": "Di", "species": "Owl", "favFoods": [], "birthYear": None},
        {"name": "Ed", "species": "Owl", "favFoods": None},
    ]
    (tmp_path / "pets.json").write_text(json.dumps({"pets": pets}, indent=2))
    landed = files.landed_files(spark, str(tmp_path / "pets.json"), "json")
    assert landed.columns == ["raw_id", "source", "file_type", "payload", "loaded_at"]
    assert rows(landed, "source", "file_type") == [("pets.json", "json")]
    records = payload_files.pet_records(landed)
    table = payload_files.pets(records)
    assert rows(table, "name", "species", "birth_year") == [("Ada", "Cat", 2016), ("Bo", "Dog", 2008), ("Cy", "Cat", 2012), ("Di", "Owl", None), ("Ed", "Owl", None)]
    foods = payload_files.pet_fav_foods(records).join(table.withColumnRenamed("id", "pet_id"), "pet_id")
    assert rows(foods, "name", "food") == [("Ada", "<b>any</b> food"), ("Ada", "fish"), ("Cy", "celery"), ("Cy", "tuna")]


def test_a_pet_without_a_name_fails_the_strict_load(spark):
    landed = spark.createDataFrame([(1, '{"pets":[{"species":"Cat"}]}')], "raw_id bigint, payload string")
    with pytest.raises(PySparkException, match="pet name is required"):
        payload_files.pets(payload_files.pet_records(landed)).collect()


def food(name, mfr="Acme", serving="29", units="g", total="110", fat="100", **parts):
    tags = {"total-fat": "11", "saturated-fat": "3", "cholesterol": "5", "sodium": "210", "carb": "2", "fiber": "0", "protein": "1", **parts}
    body = "".join(f"<{k}>{v}</{k}>" for k, v in tags.items() if v is not None)
    mfr = f"<mfr>{mfr}</mfr>" if mfr else ""
    return f'<food><name>{name}</name>{mfr}<serving units="{units}">{serving}</serving><calories total="{total}" fat="{fat}"/>{body}<vitamins><a>0</a></vitamins></food>'


def nutrition_xml():
    foods = [food(f"Food {i}") for i in range(6)]
    foods += [food("Bread, long "), food("Slaw", serving="1.5", units=" cup"), food("Eggs", serving="50", **{"total-fat": "4.5"}), food("Bits", mfr="Lyn's")]
    daily = "<daily-values><total-fat units='g'>65</total-fat><sodium>2400</sodium></daily-values>"
    return f"<?xml version='1.0'?>\n<nutrition>\n{daily}\n" + "\n".join(foods) + "\n</nutrition>"


def test_landed_xml_becomes_typed_foods(spark, tmp_path):
    (tmp_path / "nutrition.xml").write_text(nutrition_xml())
    landed = files.landed_files(spark, str(tmp_path / "nutrition.xml"), "xml")
    foods = {r.name: r for r in payload_files.nutrition_foods(landed).collect()}
    assert len(foods) == 10
    assert "Bread, long " in foods
    assert (foods["Slaw"].serving_g, foods["Slaw"].serving_units) == (Decimal("1.50"), " cup")
    assert (foods["Eggs"].total_fat, foods["Eggs"].serving_g, foods["Eggs"].calories_total) == (Decimal("4.50"), Decimal("50.00"), Decimal("110.00"))
    assert foods["Bits"].mfr == "Lyn's"


def test_foods_with_odd_numbers_and_without_a_maker(spark):
    xml = "<nutrition>" + food("a", mfr=None, sodium="", carb=None, fiber="n/a", protein="-5") + food("a", mfr=None, sodium="9") + "</nutrition>"
    landed = spark.createDataFrame([(1, xml)], "raw_id bigint, payload string")
    found = payload_files.nutrition_foods(landed).collect()
    assert [(r.mfr, r.sodium, r.carb, r.fiber, r.protein) for r in found] == [(None, None, None, None, Decimal("5.00"))]
    bad = spark.createDataFrame([(1, "<nutrition>" + food("a", sodium="4,5") + "</nutrition>")], "raw_id bigint, payload string")
    assert payload_files.nutrition_foods(bad, strict=False).first().sodium is None
    with pytest.raises(PySparkException):
        payload_files.nutrition_foods(bad).collect()


def test_xml_records_straight_from_a_file(spark, tmp_path):
    (tmp_path / "n.xml").write_text(nutrition_xml())
    schema = "name STRING, calories STRUCT<_total: STRING, _fat: STRING>"
    found = files.xml_records(spark, str(tmp_path / "n.xml"), "food", schema)
    assert found.count() == 10
    assert found.where(F.col("name") == "Bread, long ").first().calories._total == "110"


def test_files_are_landed_and_shredded_per_version(spark, tmp_path, rows):
    root, source = str(tmp_path / "t"), tmp_path / "pets.json"
    for day, names in ((1, ["Ada", "Bo"]), (2, ["Ada"])):
        source.write_text(json.dumps({"pets": [{"name": n, "favFoods": ["fish", n]} for n in names]}))
        payload_files.land(spark, root, str(source), "json", datetime(2024, 1, day))
        for _ in range(2):
            payload_files.shred_pets(spark, root, "pets.json")
    pets = spark.read.parquet(f"{root}/pets")
    assert rows(pets, "name") == [("Ada",), ("Ada",), ("Bo",)]
    assert spark.read.parquet(f"{root}/pet_fav_foods").count() == 6
    assert rows(payload_files.of_latest_files(pets, payload_files.landed(spark, root)), "name") == [("Ada",)]
    (tmp_path / "n.xml").write_text("<nutrition>" + food("a", mfr=None) + food("b") + "</nutrition>")
    payload_files.land(spark, root, str(tmp_path / "n.xml"), "xml", datetime(2024, 1, 3))
    for _ in range(2):
        payload_files.shred_nutrition(spark, root, "n.xml")
    assert rows(spark.read.parquet(f"{root}/nutrition_foods"), "name", "mfr") == [("a", None), ("b", "Acme")]


def test_an_overwritten_table_takes_the_new_columns(spark, tmp_path):
    overwrite(spark.range(3), str(tmp_path / "t"))
    overwrite(spark.range(2).withColumnRenamed("id", "other"), str(tmp_path / "t"))
    assert (spark.read.parquet(str(tmp_path / "t")).columns, spark.read.parquet(str(tmp_path / "t")).count()) == (["other"], 2)


def test_a_staged_batch_is_ordered_inside_its_files(spark, tmp_path):
    df = spark.range(100).select((99 - F.col("id")).alias("t"), F.lit("b1").alias("batch_id")).coalesce(1)
    append_batch(df, str(tmp_path / "t"), "t")
    append_batch(df.where("t < 10").withColumn("batch_id", F.lit("b2")), str(tmp_path / "t"), "t")
    table = spark.read.parquet(str(tmp_path / "t"))
    assert [r.t for r in table.where("batch_id = 'b1'").collect()] == list(range(100))
    assert table.count() == 110


def test_only_json_and_xml_can_be_landed(spark, tmp_path):
    with pytest.raises(ValueError, match="neither"):
        files.landed_files(spark, str(tmp_path), "csv")


def test_latest_payload_settles_equal_times_by_id(spark, rows):
    at = datetime(2024, 1, 1)
    landed = spark.createDataFrame(
        [("1", "a", "json", "x", at), ("2", "a", "json", "y", at), ("3", "b", "json", "z", at), ("4", "a", "xml", "w", datetime(2025, 1, 1))], files.LANDED
    )
    assert latest_payload(landed, "a", "json").first().payload == "y"
    assert rows(latest_payloads(landed), "raw_id") == [("2",), ("3",), ("4",)]


def test_csv_is_text_under_clean_names(spark, tmp_path, rows):
    (tmp_path / "b.csv").write_text('id,out/in,temp\n1,In,"3"\n2,Out,\n')
    (tmp_path / "a.csv").write_text('id,out/in,temp\n3,in,"say ""hi"", ok"\n')
    (tmp_path / "c.txt").write_text("nothing")
    assert files.first_csv(spark, str(tmp_path)).endswith("/a.csv")
    df = files.csv_text(spark, str(tmp_path))
    assert df.dtypes == [("id", "string"), ("out_in", "string"), ("temp", "string")]
    assert rows(df) == [("1", "In", "3"), ("2", "Out", None), ("3", "in", 'say "hi", ok')]


def test_a_file_with_another_header_fails_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,temp\n1,2\n")
    (tmp_path / "b.csv").write_text("temp,id\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.csv_text(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError, match="mismatch"):
        files.csv_text(spark, str(tmp_path / "a.csv"), ["id", "temperature"])


def test_a_folder_without_csv_is_an_error(spark, tmp_path):
    (tmp_path / "x.txt").write_text("")
    with pytest.raises((FileNotFoundError, PySparkException)):
        files.first_csv(spark, str(tmp_path))


def test_since_is_strict_without_and_inclusive_with_a_lookback(spark, rows):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in range(1, 8)], "t timestamp_ntz")
    assert since(df, "t", None).count() == 7
    assert since(df, "t", datetime(2024, 1, 5)).count() == 2
    assert since(df, "t", datetime(2024, 1, 5), 3).count() == 6


def test_staged_documents_carry_key_time_and_batch(spark):
    spec = SourceSpec("s", "k", "t", "source_t")
    docs = spark.createDataFrame([(7, "x", datetime(2024, 1, 1))], "_id bigint, k string, t timestamp_ntz")
    row = staged(docs, spec, "s_1", datetime(2024, 2, 1)).first()
    assert (row.k, row.source_t, row.batch_id, row.extracted_at) == ("x", datetime(2024, 1, 1), "s_1", datetime(2024, 2, 1))
    assert json.loads(row.source_doc)["_id"] == "7"


def test_batch_names_sort_by_time():
    assert batch_name("s", datetime(2024, 1, 2, 3, 4, 5)) == "s_20240102T030405"
    assert batch_name("s", datetime(2024, 1, 2, 3, 4, 5), "merge") == "s_merge_20240102T030405"


def test_documents_read_through_a_named_connector(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "c"))
    assert documents(spark, "parquet", path=str(tmp_path / "c")).count() == 3


def test_messages_decode_with_id_position_and_corrupt_text(spark):
    at = datetime(2024, 1, 1)
    frame = spark.createDataFrame(
        [
            ("k", '{"station_id":"a","value":1.5,"extra":1}', "sensors", 0, 0, at),
            ("k", "oops", "sensors", 0, 1, at),
            ("k", '{"station_id":"b","value":2}', "sensors", 1, 0, at),
        ],
        topics.MESSAGES,
    )
    found = {r._id: r for r in topics.decoded(frame, "station_id STRING, value DOUBLE").collect()}
    assert set(found) == {"sensors-0-0", "sensors-0-1", "sensors-1-0"}
    assert (found["sensors-0-0"].station_id, found["sensors-0-0"].value, found["sensors-0-0"]._corrupt_record) == ("a", 1.5, None)
    assert (found["sensors-0-1"].station_id, found["sensors-0-1"]._corrupt_record) == (None, "oops")
    assert (found["sensors-1-0"]._partition, found["sensors-1-0"]._offset) == (1, 0)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_with_quoted_breaks_is_read_by_many_tasks(spark, tmp_path, rows, end):
    texts = ["plain", f"two{end}lines", 'a ""quoted"" word', f'""{end}{end}""', "comma, inside", "", f"{end}" * 40 + "x", "é" * 30]
    for name in ("a", "b"):
        lines = [f'{i},"{texts[i % len(texts)]}",{name}' for i in range(400)]
        body = end.join(["id,Free Text,from", *lines[:200], "", *lines[200:]]) + end
        (tmp_path / f"{name}.csv").write_bytes(body.encode())
    one = files.csv_text(spark, str(tmp_path), multiline=True)
    with setting(spark, "spark.sql.files.maxPartitionBytes", "700"), setting(spark, "spark.sql.files.openCostInBytes", "0"):
        many = files.csv_split_text(spark, str(tmp_path), ["id", "Free Text", "from"])
        assert many.columns == one.columns
        assert spark.read.text(str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 20
        assert rows(many) == rows(one)
        assert len(rows(many)) == 800


def test_csv_of_other_headers_or_widths_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a\nb"\n')
    (tmp_path / "b.csv").write_text("x,z\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        files.csv_split_text(spark, str(tmp_path)).collect()
    (tmp_path / "b.csv").write_text('x,y\n"1\n"\n')
    with pytest.raises(Exception, match="MALFORMED"):
        files.csv_split_text(spark, str(tmp_path)).collect()
    assert len(files.csv_split_text(spark, str(tmp_path), strict=False).collect()) == 2


ITEM = "id BIGINT, note STRING, tags ARRAY<STRING>, at STRUCT<x: DOUBLE, inner: STRUCT<y: STRING>>, list ARRAY<STRUCT<k: STRING, v: BIGINT>>"


def array_items(n):
    """Braces, brackets, quotes and backslashes within texts, nested objects, and flat ones."""
    notes = ["}", "{[", 'say \\"}\\"', "back\\\\", '"', "line\nbreak }, {", "", "ü}\u20ac", "],[", '\\"}', None]
    for i in range(n):
        made = {"id": i, "note": notes[i % len(notes)]}
        if i % 3:
            made |= {"tags": [notes[i % 7], "]"], "list": [{"k": notes[(i + j) % 10], "v": j} for j in range(i % 5)]}
        if i % 4 == 1:
            made["at"] = {"x": i / 2, "inner": {"y": notes[(i + 5) % 10]}}
        yield made


def test_station_files_are_compressed(spark, tmp_path, rows):
    at = datetime(2024, 1, 2)
    lines = [(1000 * i, 1, 2, 3, "N", at, 50.0, 10.0, 0.09, 0.01) for i in range(5)]
    spark.createDataFrame(lines, ", ".join(f"{c} {t}" for c, t in zip(inputs.LINE, ["long"] * 4 + ["string", "timestamp_ntz"] + ["double"] * 4))).write.parquet(str(tmp_path / "lineitem.parquet"))
    alerts = REGISTRY["stations_to_parquet"].build(spark, str(tmp_path))
    assert alerts.count() == 10 and REGISTRY["station_arrays"].build(spark, str(tmp_path)).count() == 20
    work = alerts.inputFiles()[0].rsplit("/", 2)[0]
    found = [r.path for r in spark.read.format("binaryFile").load(f"{work}/json").select("path").collect()]
    assert found and all(name.endswith(".json.gz") for name in found)


def test_station_arrays_are_compressed(spark, tmp_path, rows):
    at = datetime(2024, 1, 2)
    lines = [(400 * i, 1, 2, 3, "N", at, 50.0, 10.0, 0.09, 0.01) for i in range(5)]
    spark.createDataFrame(lines, ", ".join(f"{c} {t}" for c, t in zip(inputs.LINE, ["long"] * 4 + ["string", "timestamp_ntz"] + ["double"] * 4))).write.parquet(str(tmp_path / "lineitem.parquet"))
    readings = REGISTRY["station_arrays"].build(spark, str(tmp_path))
    work = readings.inputFiles()[0].rsplit("/", 2)[0]
    found = [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{work}/json").select("path").collect()]
    assert len(found) == 2 and all(name.endswith(".gz") for name in found)
    assert rows(readings, "station_id").count(("1600-1-2-3",)) == 4 and readings.count() == 20


@pytest.mark.parametrize("size", ["64", "700", "1000000"])
def test_an_array_file_is_read_by_many_tasks(spark, tmp_path, rows, size):
    docs = list(array_items(150))
    (tmp_path / "compact.json").write_text(json.dumps(docs, separators=(",", ":")))
    (tmp_path / "indented.json").write_text(json.dumps(docs, indent=2, ensure_ascii=False) + "\n\n", encoding="utf-8")
    (tmp_path / "crlf.json").write_bytes(json.dumps(docs[:40], indent=1).replace("\n", "\r\n").encode())
    (tmp_path / "one.json").write_text('[{"id": 7}]')
    (tmp_path / "none.json").write_text(" [ ]\n")
    (tmp_path / "empty.json").write_text("")
    one = files.nested_json(spark, str(tmp_path), ITEM)
    with setting(spark, "spark.sql.files.maxPartitionBytes", size), setting(spark, "spark.sql.files.openCostInBytes", "0"):
        many = files.array_json(spark, str(tmp_path), ITEM)
        if size != "1000000":
            assert spark.read.text(str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 20
        assert many.schema == one.schema
        assert rows(many) == rows(one)
        numbered = files.json_elements(spark, str(tmp_path / "compact.json")).where("n = 149").collect()
        assert [json.loads(r.text) for r in numbered] == [docs[149]]
    assert many.count() == 341


def test_elements_across_batches_and_without_a_shuffle(spark, tmp_path, rows):
    docs = list(array_items(60))
    (tmp_path / "in.json").write_text(json.dumps(docs, indent=1, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "two.json").write_text(json.dumps(docs[:9]))
    one = rows(files.nested_json(spark, str(tmp_path), ITEM))
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "3"):
        many = files.array_json(spark, str(tmp_path), ITEM)
        assert rows(many) == one
        with setting(spark, "spark.sql.files.maxPartitionBytes", "900"), setting(spark, "spark.sql.files.openCostInBytes", "0"):
            assert rows(files.array_json(spark, str(tmp_path), ITEM)) == one
    # The first of the united parts is that of files in one range.
    text = many._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text[text.index("Union") : text.index("Scan text")]


@pytest.mark.parametrize("text", ['[{"id": 1}, {"id": 2', '[{"id": 1}', '[{"id": 1},', '{"id": 1}', '[{"id": 1}] {"id": 2}', '[{"id": 1}, 5]', "[1, 2]", '[{"id": 1}]]', '[{"id": "x}]'])
def test_a_file_that_is_no_array_of_objects_is_refused(spark, tmp_path, text):
    (tmp_path / "in.json").write_text(text)
    for strict in (True, False):
        with pytest.raises(PySparkException, match="is not one JSON array"):
            files.array_json(spark, str(tmp_path), ITEM, strict).collect()


def test_elements_that_do_not_fit(spark, tmp_path, rows):
    (tmp_path / "in.json").write_text('[{"id": 1}, 5, {"id": 2}, {"id": "x"}, {"id": 3} {"id": 4}]')
    got = rows(files.array_json(spark, str(tmp_path), "id BIGINT", strict=False))
    assert got == [(1,), (3,), (None,), (None,), (None,)]
    (tmp_path / "in.json").write_text('[{"id": 1}, 5, {"id": 2}]')
    with pytest.raises(PySparkException, match="no object"):
        files.array_json(spark, str(tmp_path), "id BIGINT").collect()
    (tmp_path / "in.json").write_text('[{"id": 1}, {"id": "x"}]')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.array_json(spark, str(tmp_path), "id BIGINT").collect()


def test_rejects_of_xml_are_counted(spark):
    good, bad = food("a"), food("b", serving="lots", total="n/a", fiber=" ")
    nameless = food("c").replace("<name>c</name>", "")
    texts = [f"<nutrition>{good}{bad}{nameless}</nutrition>", f"<nutrition>{bad}", "<nutrition></nutrition>", None]
    landed = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "raw_id string, payload string")
    found = {r.check_name: r.error_count for r in payload_files.food_rejects(landed).collect()}
    assert {name: n for name, n in found.items() if n} == {
        "payloads_unreadable": 1, "foods_null_name": 1, "foods_unreadable_serving_g": 1, "foods_unreadable_calories_total": 1,
    }
    assert len(found) == 12
    assert {r.error_count for r in payload_files.food_rejects(landed.limit(0)).collect()} == {0}
