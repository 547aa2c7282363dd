"""Warehouse tables on plain Parquet: sliced, replaced slice by slice, committed together.

A table is a folder of ``version=<v>/slice=<n>`` folders. A merge writes the slices it changed to a new
version folder, and one write below ``meta/commits`` makes them current for all its tables at once. A slice
in which no known key changed is not rewritten: the commit only adds the new rows to it. Nothing that is
being read is overwritten, and a failed run leaves no trace in the result.

Rows of a merged source live in the slice of the month their key was first seen in, and of the hash of the key: its home.
Homes of known keys are looked up in the key directory of the source, which is only added to. So a merge
rewrites slices of the months its known keys come from, and all other months stay as they are.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.hashing import hash_slice

COMMITS = (
    "commit_seq BIGINT, version STRING, table_name STRING, replaced ARRAY<INT>, added ARRAY<INT>, committed_at TIMESTAMP_NTZ"
)
LAYOUT = "slices INT"
#: The slice a row was read from, or is to be written to.
HOME = "home"


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows of the job's own as one constant of the plan: no Python worker is started for them."""
    fields = T.StructType.fromDDL(schema)
    text = json.dumps([dict(zip(fields.names, row)) for row in rows], default=lambda value: value.isoformat())
    frame = spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), T.ArrayType(fields))))
    return frame if rows else frame.limit(0)


def create_if_missing(spark: SparkSession, path: str, schema: str, *partition_by: str) -> None:
    """An empty table, unless there is one already."""
    local_rows(spark, [], schema).write.mode("ignore").partitionBy(*partition_by).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str, *partition_by: str) -> DataFrame:
    """The table, or no rows if it was never written."""
    create_if_missing(spark, path, schema, *partition_by)
    return spark.read.schema(schema).parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Full refresh: the rows, and the columns, become the whole table."""
    df.write.mode("overwrite").parquet(path)


def append_rows(spark: SparkSession, rows: Sequence[tuple], schema: str, path: str) -> None:
    """Add a few records of the job's own, such as a log row, as one small file."""
    local_rows(spark, rows, schema).write.mode("append").parquet(path)


def append_batch(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """Add one batch, as its own partition. Writing the same batch id again replaces it, so a retry is safe.

    Rows are ordered inside each file only, which gives tight min/max statistics without a global sort.
    """
    rows = df.sortWithinPartitions("batch_id", order_by) if order_by else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id").parquet(path)


@dataclass(frozen=True)
class Snapshot:
    """The current slices of every table at one moment; reads through it see one consistent state.

    ``live`` maps table and version to the slices the version contributes to. ``next_seq`` numbers the next
    commit: what the newest commit wrote is always current, so its number is the largest to be found.
    """

    wh: Warehouse
    next_seq: int
    live: Mapping[str, Mapping[str, Sequence[int]]]

    def slices(self, table: str) -> list[int]:
        return sorted({s for owned in self.live.get(table, {}).values() for s in owned})

    def read(self, table: str, schema: str, slices: Iterable[int] | None = None, home: bool = False) -> DataFrame:
        """Current rows of a table, or of some slices of it, with their slice if asked: files of other slices are not read."""
        wanted = None if slices is None else set(slices)
        versions = {
            version: [s for s in owned if wanted is None or s in wanted]
            for version, owned in sorted(self.live.get(table, {}).items())
        }
        versions = {version: owned for version, owned in versions.items() if owned}
        if not versions:
            return local_rows(self.wh.spark, [], f"{schema}, {HOME} INT" if home else schema)
        base = self.wh.path(table)
        reader = self.wh.spark.read.schema(f"{schema}, version STRING, slice INT").option("basePath", base)
        rows = reader.parquet(*[f"{base}/version={v}" for v in versions])
        current = [(F.col("version") == v) & F.col("slice").isin(owned) for v, owned in versions.items()]
        rows = rows.where(reduce(Column.__or__, current)).drop("version")
        return rows.withColumnRenamed("slice", HOME) if home else rows.drop("slice")


@dataclass(frozen=True)
class Warehouse:
    """Folders of one warehouse. ``slices`` is fixed when it is created: it decides where a key lives.

    Choose it so that what one month adds to a slice is a few hundred MB at full size. One writer at a time.
    """

    spark: SparkSession
    root: str
    slices: int

    @classmethod
    def create(cls, spark: SparkSession, root: str, slices: int) -> Warehouse:
        """Open a warehouse, creating it if absent; another slice count than at creation is an error."""
        path = f"{root}/meta/layout"
        known = read_or_empty(spark, path, LAYOUT).first()
        if known is None:
            append_rows(spark, [(slices,)], LAYOUT, path)
        elif known.slices != slices:
            raise ValueError(f"{root} was created with {known.slices} slices, not {slices}")
        return cls(spark, root, slices)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def key_slice(self, key: str) -> Column:
        return hash_slice(key, self.slices)

    def home_slice(self, key: str, first_seen: str) -> Column:
        """The slice of a key by the month it was first seen in and its hash; without a time, that of no month."""
        month = F.coalesce(F.year(first_seen) * 12 + F.month(first_seen), F.lit(0))
        return (month * self.slices + self.key_slice(key)).cast("int")

    # ---- staging -------------------------------------------------------------------------------------

    def stage(self, df: DataFrame, source: str, order_by: str) -> None:
        append_batch(df, self.path(f"staging/{source}"), order_by)

    def staging(self, source: str, schema: str, batch_id: str | None = None) -> DataFrame:
        rows = read_or_empty(self.spark, self.path(f"staging/{source}"), schema, "batch_id")
        return rows if batch_id is None else rows.where(F.col("batch_id") == batch_id)

    # ---- sliced tables -------------------------------------------------------------------------------

    def commits(self) -> DataFrame:
        """Every commit is a folder of its own, named by its number."""
        create_if_missing(self.spark, self.path("meta/commits/0"), COMMITS)
        return self.spark.read.schema(COMMITS).option("recursiveFileLookup", True).parquet(self.path("meta/commits"))

    def snapshot(self, until: int | None = None) -> Snapshot:
        """What is current now, or was after a commit: for each slice its last replacement and what was added after that.

        One small row per table and version reaches the driver.
        """
        made = self.commits() if until is None else self.commits().where(F.col("commit_seq") <= until)
        commits = made.select(
            "table_name", "commit_seq", "version", F.explode(F.concat("replaced", "added")).alias("slice"), "replaced"
        )
        replaces = F.array_contains("replaced", F.col("slice"))
        last_replaced = F.max(F.when(replaces, F.col("commit_seq"))).over(Window.partitionBy("table_name", "slice"))
        owners = (
            commits.withColumn("since", F.coalesce(last_replaced, F.lit(0)))
            .where(F.col("commit_seq") >= F.col("since"))
            .groupBy("table_name", "version")
            .agg(F.max("commit_seq").alias("commit_seq"), F.sort_array(F.collect_list("slice")).alias("slices"))
        )
        live: dict[str, dict[str, list[int]]] = {}
        seq = 0
        for row in owners.collect():
            live.setdefault(row.table_name, {})[row.version] = row.slices
            seq = max(seq, row.commit_seq)
        return Snapshot(self, seq + 1, live)

    def changed_since(self, table: str, seq: int) -> list[int]:
        """Slices of a table that later commits replaced or added to."""
        later = self.commits().where((F.col("table_name") == table) & (F.col("commit_seq") > seq))
        return [row[0] for row in later.select(F.explode(F.concat("replaced", "added"))).distinct().collect()]

    def read(self, table: str, schema: str, slices: Iterable[int] | None = None) -> DataFrame:
        return self.snapshot().read(table, schema, slices)

    def write_version(self, df: DataFrame, table: str, version: str, slice_of: Column) -> None:
        """Write changed slices to a version folder. Not visible before ``commit``.

        The rebalance keeps a slice's rows together in as few files as their size allows, and splits a
        slice that holds far more than the others, such as the children of one huge parent.
        """
        rows = df.withColumn("slice", slice_of).drop(HOME).hint("rebalance", "slice")
        rows.write.mode("overwrite").partitionBy("slice").parquet(f"{self.path(table)}/version={version}")

    def read_version(self, table: str, version: str, schema: str) -> DataFrame:
        """Rows of a version that may not be committed yet."""
        return self.spark.read.schema(schema).parquet(f"{self.path(table)}/version={version}")

    def written_slices(self, table: str, version: str) -> list[int]:
        """Slices a version wrote rows to, from the folder names: no column is read."""
        rows = self.spark.read.schema("slice INT").parquet(f"{self.path(table)}/version={version}")
        return [row.slice for row in rows.distinct().collect()]

    def commit(
        self,
        seq: int,
        version: str,
        tables: Iterable[str],
        replaced: Iterable[int],
        at: datetime,
        added: Iterable[int] = (),
        others: Mapping[str, tuple[Iterable[int], Iterable[int]]] | None = None,
    ) -> None:
        """Make what the version wrote current, for all tables in one write.

        In ``replaced`` slices it takes the place of what was there, even if it wrote no row to them; to
        ``added`` slices it adds its rows. ``others`` are tables with slices of their own. A number can be committed once: of two writers that began from one
        snapshot the second fails, and what it wrote stays invisible.
        """
        changes = {table: (replaced, added) for table in tables} | dict(others or {})
        lists = [(table, sorted(old), sorted(new)) for table, (old, new) in changes.items()]
        rows = local_rows(self.spark, [(seq, version, *change, at) for change in lists], COMMITS)
        rows.write.mode("errorifexists").parquet(self.path(f"meta/commits/{seq}"))

    def compact(self, table: str, schema: str, at: datetime) -> None:
        """Rewrite the slices that several versions have added to, each as one version."""
        now = self.snapshot()
        versions = Counter(s for owned in now.live.get(table, {}).values() for s in owned)
        grown = [s for s, times in versions.items() if times > 1]
        if grown:
            version = f"compact-{now.next_seq}"
            self.write_version(now.read(table, schema, grown, home=True), table, version, F.col(HOME))
            self.commit(now.next_seq, version, [table], grown, at)

    # ---- small append-only tables --------------------------------------------------------------------

    def log(self, table: str, schema: str) -> DataFrame:
        return read_or_empty(self.spark, self.path(f"meta/{table}"), schema)

    def append_log(self, table: str, rows: list[tuple], schema: str) -> None:
        append_rows(self.spark, rows, schema, self.path(f"meta/{table}"))


def touched_slices(df: DataFrame, slice_of: Column) -> list[int]:
    """Slices that hold any row of the frame: at most as many integers as the table has slices."""
    return [row[0] for row in df.select(slice_of.alias("slice")).distinct().collect()]
