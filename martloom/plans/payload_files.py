"""Landed JSON and XML payloads to normalised tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.documents import parse_document
from martloom.functions.hashing import surrogate_id
from martloom.functions.numbers import amount
from martloom.functions.times import moment
from martloom.operators.latest import latest_payload, latest_payloads
from martloom.operators.merge import insert_ignore
from martloom.operators.quality import Rule, check, unreadable
from martloom.operators.shape import required
from martloom.operators.shred import ITEM, POSITION, first_of_each, items
from martloom.sinks.warehouse import read_or_empty
from martloom.sources.files import LANDED, landed_files, mode_of

PETS = (
    "pets ARRAY<STRUCT<name: STRING, species: STRING, favFoods: ARRAY<STRING>, birthYear: STRING, photo: STRING>>"
)
NUTRITION = (
    "food ARRAY<STRUCT<name: STRING, mfr: STRING, serving: STRUCT<_VALUE: STRING, _units: STRING>, "
    "calories: STRUCT<_total: STRING, _fat: STRING>, `total-fat`: STRING, `saturated-fat`: STRING, "
    "cholesterol: STRING, sodium: STRING, carb: STRING, fiber: STRING, protein: STRING>>"
)
# Output column and where its text sits in a food element.
AMOUNTS = {
    "serving_g": "serving._VALUE",
    "calories_total": "calories._total",
    "calories_fat": "calories._fat",
    "total_fat": "`total-fat`",
    "saturated_fat": "`saturated-fat`",
    "cholesterol": "cholesterol",
    "sodium": "sodium",
    "carb": "carb",
    "fiber": "fiber",
    "protein": "protein",
}


def pet_records(landed: DataFrame, strict: bool = True) -> DataFrame:
    """One row per pet with its foods still nested; of pets with one name in a file the first counts."""
    parsed = landed.select("raw_id", parse_document("payload", PETS, strict).alias("doc"))
    found = items(parsed, "doc.pets", ["raw_id"]).select("raw_id", POSITION, f"{ITEM}.*")
    name = required(F.col("name"), "pet name") if strict else F.col("name")
    year = F.col("birthYear")
    rows = found.select(
        "raw_id",
        POSITION,
        name.alias("name"),
        "species",
        (year.cast("int") if strict else year.try_cast("int")).alias("birth_year"),
        "photo",
        F.col("favFoods").alias("fav_foods"),
    )
    first = first_of_each(rows, ["raw_id", "name"], POSITION).drop(POSITION)
    return first.withColumn("id", surrogate_id("raw_id", "name"))


def pets(records: DataFrame) -> DataFrame:
    return records.select("id", "name", "species", "birth_year", "photo", "raw_id")


def pet_fav_foods(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each food once per pet; pets without foods have no rows. ``keep`` carries columns of the pet along."""
    foods = items(records, F.array_distinct("fav_foods"), [F.col("id").alias("pet_id"), *keep])
    return foods.select("pet_id", *keep, required(F.col(ITEM), "food").alias("food"))


def nutrition_foods(landed: DataFrame, strict: bool = True) -> DataFrame:
    """Food elements of landed XML with their numbers typed. Other elements of the file are not read."""
    options = {"ignoreSurroundingSpaces": "false", "mode": mode_of(strict)}
    parsed = landed.select("raw_id", F.from_xml("payload", NUTRITION, options).alias("doc"))
    foods = items(parsed, "doc.food", ["raw_id"]).select("raw_id", POSITION, f"{ITEM}.*")
    rows = foods.select(
        required(F.col("name"), "food name").alias("name") if strict else "name",
        "mfr",
        *[amount(F.col(path), strict).alias(name) for name, path in AMOUNTS.items()],
        F.col("serving._units").alias("serving_units"),
        "raw_id",
        POSITION,
    )
    first = first_of_each(rows, ["name", "mfr", "raw_id"], POSITION).drop(POSITION)
    return first.select(surrogate_id("raw_id", "name", "mfr").alias("id"), *first.columns)


def unreadable_payloads(landed: DataFrame, schema: str = PETS) -> DataFrame:
    """``check_name, error_count``: how many JSON payloads a tolerant load cannot read as a whole."""
    doc = parse_document("payload", f"{schema}, _corrupt_record STRING", strict=False)
    return check(landed.select(doc.alias("doc")), [Rule("payloads_unreadable", F.col("doc._corrupt_record").isNotNull())])


def food_rejects(landed: DataFrame) -> DataFrame:
    """``check_name, error_count``: what a tolerant load of landed XML turns into null, from one scan.

    Payloads that cannot be read as a whole, foods without a name, and numbers by column; every element of a file counts.
    """
    options = {"ignoreSurroundingSpaces": "false", "mode": mode_of(strict=False)}
    parsed = landed.select(F.from_xml("payload", f"{NUTRITION}, _corrupt_record STRING", options).alias("doc"))
    rows = parsed.select(F.col("doc._corrupt_record").alias("broken"), F.posexplode_outer("doc.food").alias(POSITION, ITEM))
    first = F.coalesce(F.col(POSITION), F.lit(0)) == 0
    rules = [
        Rule("payloads_unreadable", F.col("broken").isNotNull() & first),
        Rule("foods_null_name", F.col(POSITION).isNotNull() & F.col(f"{ITEM}.name").isNull()),
    ]
    texts = {name: F.col(f"{ITEM}.{path}") for name, path in AMOUNTS.items()}
    return check(rows, rules + [unreadable("foods", name, F.trim(text), amount(text, strict=False)) for name, text in texts.items()])


PETS_TABLE = "id STRING, name STRING, species STRING, birth_year INT, photo STRING, raw_id STRING"
FOODS_TABLE = "pet_id STRING, food STRING"
NUTRITION_TABLE = (
    "id STRING, name STRING, mfr STRING, "
    + ", ".join(f"{name} DECIMAL(10,2)" for name in AMOUNTS)
    + ", serving_units STRING, raw_id STRING"
)


def land(spark: SparkSession, root: str, path: str | list[str], file_type: str, loaded_at: datetime) -> None:
    """Add files to the raw table as they are."""
    rows = landed_files(spark, path, file_type, moment(loaded_at))
    rows.write.mode("append").partitionBy("file_type").parquet(f"{root}/raw")


def landed(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/raw", LANDED, "file_type")


def _append_new(spark: SparkSession, path: str, schema: str, rows: DataFrame, keys: Sequence[str]) -> None:
    known = read_or_empty(spark, path, schema)
    insert_ignore(known, rows.select(*known.columns), keys, only_new=True).write.mode("append").parquet(path)


def shred_pets(spark: SparkSession, root: str, source: str, strict: bool = True) -> None:
    """Pets and their foods from the payload of a source that was landed last. Known rows stay as they are."""
    records = pet_records(latest_payload(landed(spark, root), source, "json"), strict)
    _append_new(spark, f"{root}/pets", PETS_TABLE, pets(records), ["name", "raw_id"])
    _append_new(spark, f"{root}/pet_fav_foods", FOODS_TABLE, pet_fav_foods(records), ["pet_id", "food"])


def shred_nutrition(spark: SparkSession, root: str, source: str, strict: bool = True) -> None:
    """Foods from the payload of a source that was landed last. Known rows, null makers included, stay."""
    rows = nutrition_foods(latest_payload(landed(spark, root), source, "xml"), strict)
    _append_new(spark, f"{root}/nutrition_foods", NUTRITION_TABLE, rows, ["name", "mfr", "raw_id"])


def of_latest_files(rows: DataFrame, raw: DataFrame) -> DataFrame:
    """Rows that stem from the newest file of their source; older files' rows are kept, but not shown."""
    return rows.join(latest_payloads(raw).select("raw_id"), "raw_id", "left_semi").select(*rows.columns)
