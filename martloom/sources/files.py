"""File sources: nested JSON, raw payloads, XML records, text-only CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.hashing import surrogate_id
from martloom.functions.headers import check_header, with_clean_header
from martloom.sources import array_pieces

LANDED = "raw_id STRING, source STRING, file_type STRING, payload STRING, loaded_at TIMESTAMP_NTZ"


def mode_of(strict: bool) -> str:
    """How a reader treats a record that does not fit: it stops, or gives nulls."""
    return "FAILFAST" if strict else "PERMISSIVE"


def nested_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str, multiline: bool = True, strict: bool = True) -> DataFrame:
    """Nested records with a declared schema, so no extra pass infers one. A strict read fails on a broken record.

    A multi-line file is read by one task; many files, or JSON lines, spread the work, and ``array_json`` splits a file.
    """
    reader = spark.read.schema(schema).option("mode", mode_of(strict))
    return reader.option("multiLine", multiline).json(path)


def json_elements(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """file, n (from 0) and text of every object in files that are one JSON array each; a file is read by many tasks.

    A file is read in pieces that end in a closing brace, whether or not there are line breaks. Two things tell what a piece is
    part of: whether it begins inside a string, and how deep it is nested. Both are running sums, inside a task over its own range of
    the file, and over one row per range for all before that. A file that is one range is read once, and none of it is
    shuffled. One of several ranges is measured first, for either way a range may begin; then elements inside a range are put
    together where they are read, and only those that may lie across ranges are shuffled. No task holds more than a batch of pieces and one element.

    A file that is no array, ends early, or ends in an element that is no object fails the read; an empty file has no elements.
    Another element that is no object fails it if strict; otherwise it and the object behind it give one null text.
    """
    file, start, length, size = (F.col(f"_metadata.{c}") for c in ("file_path", "file_block_start", "file_block_length", "file_size"))
    # A file no longer than this is never split. By the size alone, such files are left out before they are opened.
    conf = spark._jsparkSession.sessionState().conf()
    least = min(conf.filesMaxPartitionBytes(), conf.filesOpenCostInBytes())
    spots = (file.alias("file"), start.alias("range"))
    pieces = spark.read.option("lineSep", "}").text(path)
    alone = pieces.where((length >= size) | (size <= least)).select(*spots, "value")
    several = pieces.where((size > least) & (length < size)).select(*spots, "value")
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: Column) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    def by_side(name: str) -> Column:
        return F.when(F.col("side") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    ranges = several.mapInArrow(array_pieces.measured, array_pieces.RANGE).withColumn("side", before(F.col("odd")) % 2)
    ranges = ranges.withColumns({"depth": before(by_side("total")), "all": F.sum(by_side("total")).over(Window.partitionBy("file"))})
    base = before(F.when(by_side("least") + F.col("depth") == 1, by_side("n")).otherwise(0))
    ranges = ranges.select("file", "range", "side", F.col("depth").alias("above"), "all", base.alias("base"))
    # One row per range; the pieces keep their order beside a broadcast table.
    placed = several.join(F.broadcast(ranges), ["file", "range"])
    known = {"side": F.lit(0), "above": F.lit(0), "all": F.lit(None).cast("bigint"), "base": F.lit(0)}
    inside = [rows.mapInArrow(array_pieces.cut(True), array_pieces.ELEMENT).select("file", "n", "text") for rows in (alone.withColumns(known), placed)]
    parts = placed.mapInArrow(array_pieces.cut(False), array_pieces.ELEMENT)
    joined = parts.groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("range", "text"))).alias("parts"))
    elements = inside[0].union(inside[1]).union(joined.select("file", "n", F.array_join("parts.text", "").alias("text")))
    lead = F.when(F.col("n") == 0, F.lit(r"^\uFEFF?\s*\[\s*(?=\{)")).otherwise(F.lit(r"^\s*,\s*(?=\{)"))
    other = F.raise_error(F.concat(F.col("file"), F.lit(" has an element that is no object"))).cast("string") if strict else F.lit(None)
    led = F.regexp_substr("text", lead)
    text = F.when(led.isNotNull(), F.substr("text", F.length(led) + 1)).otherwise(other)
    return elements.select("file", "n", text.alias("text"))


def array_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """What ``nested_json`` reads from files that are one JSON array each, by many tasks a file (see ``json_elements``)."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    element = F.from_json("text", fields, {"mode": mode_of(strict)})
    # Out of a generator, so that a filter on a field stays above it and an element is parsed once.
    rows = json_elements(spark, path, strict).select(F.inline(F.array(F.struct(element.alias("r")))))
    return rows.select(*[F.col("r").getField(name).alias(name) for name in fields.names])


def landed_files(spark: SparkSession, path: str | list[str], file_type: str, loaded_at: Column | None = None) -> DataFrame:
    """One row per file with its whole text, name and type."""
    if file_type not in ("json", "xml"):
        raise ValueError(f"file type {file_type!r} is neither json nor xml")
    files = spark.read.text(path, wholetext=True)
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    rows = files.select(
        F.col("_metadata.file_name").alias("source"),
        F.lit(file_type).alias("file_type"),
        F.col("value").alias("payload"),
        stamp.cast("timestamp_ntz").alias("loaded_at"),
    )
    return rows.withColumn("raw_id", surrogate_id("source", "file_type", "loaded_at", "payload")).select(
        "raw_id", "source", "file_type", "payload", "loaded_at"
    )


def xml_records(
    spark: SparkSession, path: str | list[str], row_tag: str, schema: T.StructType | str, strict: bool = True
) -> DataFrame:
    """One row per element; text keeps its surrounding spaces. A strict read fails on a broken element."""
    return (
        spark.read.format("xml")
        .schema(schema)
        .option("mode", mode_of(strict))
        .option("rowTag", row_tag)
        .option("ignoreSurroundingSpaces", False)
        .load(path)
    )


def csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """The CSV files of a folder, names only: no content is read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path")


def first_csv(spark: SparkSession, folder: str) -> str:
    """Path of the first CSV file of a folder by name; none is an error."""
    path = csv_files(spark, folder).agg(F.min("path")).first()[0]
    if path is None:
        raise FileNotFoundError(f"no *.csv file in {folder}")
    return path


def csv_text(
    spark: SparkSession,
    path: str | list[str],
    expected: Sequence[str] | None = None,
    strict: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Header CSV with every column as text under its cleaned name.

    A strict read fails on a row with too few or too many fields. ``multiline`` reads fields with line breaks in quotes;
    such a file is read by one task; ``csv_split_text`` takes many.

    The first file's header sets the schema, and Spark then holds every other file's header against it
    while it scans: a file with other columns fails the read in place of shifting values.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv").option("escape", '"').option("multiLine", multiline)
    header = reader.csv(path).columns
    if expected is not None:
        check_header(header, expected)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    rows = reader.schema(schema).option("enforceSchema", False).option("mode", mode_of(strict))
    return with_clean_header(rows.csv(path))


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, n (from 1) and text of every CSV record, where quoted fields may hold line breaks; a file is read by many tasks.

    Whether a line begins inside quotes follows from the parity of the quotes before it: in its own range of the file by a
    running sum, and in all ranges before that by a running sum over one row per range. The sums hold as far as a range
    reaches, so no task gets more than a range of a file, and one row per range of all others. Records of one line stay where they are read; only
    pieces of longer ones are shuffled, by record. Quotes inside a field are doubled, as the standard asks; a file that puts bare
    ones into fields without quotes needs the one-task read. Blank lines between records are skipped. In a file
    whose first line ends in CR LF, so do all, and those inside quotes become LF, as the one-task read has it.
    """
    spot = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"))
    files = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.csv").text(path)
    lines = files.select(*spot, F.monotonically_increasing_id().alias("at"), "value")
    lines = lines.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    until = Window.partitionBy("file", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    odd = F.col("quotes") % 2
    lines = lines.withColumn("inside", (F.sum("quotes").over(until) - F.col("quotes")) % 2)
    # Begins of records if the range begins outside of quotes, and if it begins inside.
    filled = ~F.col("value").isin("", "\r")
    begins = [((F.col("inside") == side) & filled).cast("long") for side in (0, 1)]
    lines = lines.withColumns({f"n{side}": F.sum(begins[side]).over(until) for side in (0, 1)})
    ranges = lines.groupBy("file", "range").agg(
        (F.sum("quotes") % 2).alias("odd"),
        *[F.max(f"n{side}").alias(f"all{side}") for side in (0, 1)],
        F.min_by(F.endswith("value", F.lit("\r")), "at").alias("crlf"),
    )
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("side", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    count = F.when(F.col("side") == 0, F.col("all0")).otherwise(F.col("all1"))
    first = F.coalesce(F.first("crlf").over(earlier), F.col("crlf")).alias("crlf")
    ranges = ranges.select("file", "range", "side", F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias("base"), first)
    placed = lines.join(ranges, ["file", "range"])
    outside = F.col("inside") == F.col("side")
    number = F.col("base") + F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1"))
    spots = placed.select("file", "range", "at", "value", "crlf", number.alias("n"), outside.alias("outside"), odd.alias("odd"))
    placed = spots.where(~F.col("outside") | filled)
    single = placed.where("outside AND odd = 0").select("file", "n", "crlf", F.col("value").alias("text"))
    pieces = placed.where("NOT (outside AND odd = 0)").groupBy("file", "n", "crlf")
    joined = pieces.agg(F.array_sort(F.collect_list(F.struct("range", "at", "value"))).alias("pieces"))
    joined = joined.select("file", "n", "crlf", F.array_join("pieces.value", "\n").alias("text"))
    joined = joined.withColumn("text", F.when(F.col("crlf"), F.replace("text", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("text")))
    text = F.when(F.col("crlf"), F.regexp_replace("text", "\r$", "")).otherwise(F.col("text")).alias("text")
    return single.unionByName(joined).select("file", "n", text)


def csv_split_text(spark: SparkSession, path: str | list[str], expected: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """What ``csv_text`` with ``multiline`` reads, by many tasks a file (see ``csv_records``).

    The first file's header sets the schema; a file with another header fails the read.
    """
    found = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("pathGlobFilter", "*.csv")
    header = found.csv(path).columns
    if expected is not None:
        check_header(header, expected)
    options = {"escape": '"', "multiLine": "true", "mode": mode_of(strict)}
    schema = ", ".join(f"c{i} STRING" for i in range(len(header)))
    rows = csv_records(spark, path).select("n", F.from_csv("text", schema, options).alias("r"))
    same = F.array(*[F.col(f"r.c{i}") for i in range(len(header))]) == F.array(*[F.lit(name) for name in header])
    other = F.raise_error(F.lit("a file has another header than the first"))
    rows = rows.where(F.when(F.col("n") > 1, True).when(same, False).otherwise(other.cast("boolean")))
    return with_clean_header(rows.select(*[F.col(f"r.c{i}").alias(name) for i, name in enumerate(header)]))
