"""Incremental document load: extract, stage, merge, check, and only then move the watermark."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martloom.functions.times import moment
from martloom.operators.latest import fold_latest
from martloom.operators.merge import ACTION, replace_children, split_rejects, upsert
from martloom.operators.quality import all_checks, check, check_batch_size, check_parent, check_unique, gate, not_null
from martloom.plans.warehouse import SOURCES, Child, Source
from martloom.session import workspace
from martloom.sinks.runlog import RunLog, advance_watermark, new_run_id, seed_watermarks
from martloom.sinks.warehouse import HOME, Snapshot, Warehouse, touched_slices
from martloom.sources.documents import batch_name, raw_rows, since, with_provenance

MERGED = "merged"
DIRECTORY = "key STRING, place INT"


@dataclass(frozen=True)
class StagedBatch:
    """What was extracted, what of it is found in staging, and the newest time among that."""

    batch_id: str
    extracted: int
    loaded: int
    newest: datetime | None


@dataclass(frozen=True)
class MergeCounts:
    inserted: int
    updated: int
    rejected: int


def extract(
    wh: Warehouse,
    source: Source,
    docs: DataFrame,
    watermark: datetime | None,
    batch_id: str,
    run_ts: datetime,
    lookback_days: int | None = None,
) -> StagedBatch:
    """Stage what is new since the watermark."""
    return stage(wh, source, since(docs, source.spec.watermark_field, watermark, lookback_days), batch_id, run_ts)


def stage(wh: Warehouse, source: Source, docs: DataFrame, batch_id: str, run_ts: datetime) -> StagedBatch:
    return stage_rows(wh, source, raw_rows(docs, source.spec), batch_id, run_ts)


def stage_rows(wh: Warehouse, source: Source, raw: DataFrame, batch_id: str, run_ts: datetime) -> StagedBatch:
    """Stage raw rows, and tell what is found there."""
    spec = source.spec
    seen = Observation()
    # No shuffle lies between the count and the write, so each row is observed once.
    rows = with_provenance(raw.observe(seen, F.count(F.lit(1)).alias("n")), batch_id, run_ts)
    wh.stage(rows, spec.name, spec.staged_field)
    batch = wh.staging(spec.name, spec.staging_schema, batch_id)
    loaded = batch.agg(F.count(F.lit(1)).alias("n"), F.max(spec.staged_field).alias("newest")).first()
    return StagedBatch(batch_id, seen.get["n"], loaded.n, loaded.newest)


def homes_of(now: Snapshot, source: Source, arrived: DataFrame) -> DataFrame:
    """key, home and whether it was known before, for every key that arrived; written once.

    Known keys are looked up in the directory, in the hash slices of the batch and by two narrow columns. A new key
    is at home in the month of the earliest time it arrived with, which a retry of the batch finds again.
    """
    wh, key = now.wh, source.key
    first = arrived.groupBy(F.col(key).alias("_arrived")).agg(F.min(source.spec.staged_field).alias("_first"))
    hashed = touched_slices(arrived, wh.key_slice(key))
    known = now.read(directory(source), DIRECTORY, hashed)
    met = first.join(known, F.col("key").eqNullSafe(F.col("_arrived")), "left")
    home = F.coalesce("place", wh.home_slice("_arrived", "_first")).alias(HOME)
    path = workspace(wh.spark, "homes")
    met.select(F.col("_arrived").alias("key"), home, F.col("place").isNotNull().alias("known")).write.parquet(path)
    return wh.spark.read.schema(f"key STRING, {HOME} INT, known BOOLEAN").parquet(path)


def directory(source: Source) -> str:
    return f"keys/{source.spec.name}"


def at_home(rows: DataFrame, homes: DataFrame, key: str) -> DataFrame:
    """The rows with the home of their key; null keys equal each other."""
    own = homes.select(F.col("key").alias("_key"), HOME)
    return rows.join(own, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def merge(wh: Warehouse, source: Source, batch_id: str, run_ts: datetime) -> MergeCounts:
    """Merge one staged batch into the parent table and its child tables.

    ``latest/<source>`` keeps the winning raw document of every key, so a merge folds the batch into the
    slices it touches and never re-reads older batches. Only slices that are home to a known key of the batch are
    read and rewritten; to others it adds. All tables and the key directory become current in one commit, which is refused,
    and the version left invisible, when a required column is null, a key repeats or a child has no parent.
    """
    spec, key = source.spec, source.key
    arrived = wh.staging(spec.name, spec.staging_schema, batch_id)
    now = wh.snapshot()
    homes = homes_of(now, source, arrived)
    slices, hit = touched_slices(homes, F.col(HOME)), touched_slices(homes.where("known"), F.col(HOME))
    if not slices:
        return MergeCounts(0, 0, 0)
    version = f"{batch_id}-{now.next_seq}"
    raw_table = f"latest/{spec.name}"
    raw_schema = f"{spec.staging_schema}, {MERGED} BOOLEAN"

    fresh = homes.where("NOT known")
    new_slices = touched_slices(fresh, wh.key_slice("key"))
    if new_slices:
        entries = fresh.select("key", F.col(HOME).alias("place"))
        wh.write_version(entries, directory(source), version, wh.key_slice("key"))

    known = now.read(raw_table, raw_schema, hit, home=True)
    winners = fold_latest(known, at_home(arrived, homes, key), key, spec.staged_field, ["batch_id", "id"], MERGED)
    wh.write_version(winners, raw_table, version, F.col(HOME))
    # A winner lies in the slice it is at home in, so what is made of it needs no look-up.
    changed = wh.read_version(raw_table, version, f"{raw_schema}, slice INT").where(MERGED).withColumnRenamed("slice", HOME)

    rows, rejected = source.rows(changed), None
    if source.accepted is not None:
        rows, rejected = split_rejects(rows, source.accepted())

    def write_child(child: Child) -> None:
        stamped = child.rows(changed).withColumn("loaded_at", moment(run_ts))
        children = replace_children(now.read(child.table, child.schema, hit, home=True), changed, stamped, key)
        wh.write_version(children, child.table, version, F.col(HOME))

    # Parent and child tables only depend on the winners: their writes share the cluster.
    with ThreadPoolExecutor(max_workers=1 + len(source.children)) as pool:
        parent = pool.submit(_merge_parent, now, source, rows, hit, version, run_ts)
        for done in [pool.submit(write_child, child) for child in source.children]:
            done.result()
        counts = parent.result()

    # Parent and children of a key share a home, so what the version wrote can be judged by itself.
    written = {t: wh.read_version(t, version, schema) for t, schema in source.schemas()}
    named = check(written[source.table], not_null(spec.name, key))
    gate(all_checks([named, *constraints(source, written)]))
    tables = [raw_table, source.table, *[c.table for c in source.children]]
    entered = {directory(source): ([], new_slices)} if new_slices else {}
    wh.commit(now.next_seq, version, tables, hit, run_ts, added=set(slices) - set(hit), others=entered)
    return MergeCounts(*counts, 0 if rejected is None else rejected.count())


def _merge_parent(now: Snapshot, source: Source, rows: DataFrame, slices: list[int], version: str, run_ts: datetime) -> tuple[int, int]:
    wh = now.wh
    target = now.read(source.table, source.schema, slices, home=True)
    columns = [c for c in rows.columns if c not in (source.key, HOME)]
    merged = upsert(target, rows, [source.key], columns, run_ts, "loaded_at", source.modified, with_action=True)
    wh.write_version(merged, source.table, version, F.col(HOME))
    actions = wh.read_version(source.table, version, f"{ACTION} STRING").agg(
        *[F.count_if(F.col(ACTION) == a).alias(a) for a in ("insert", "update")]
    )
    row = actions.first()
    return row["insert"], row["update"]


def constraints(source: Source, tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Required columns, unique keys and no orphans in the given tables of a source, by name."""
    name, parent = source.spec.name, tables[source.table]
    results = [check(parent, not_null(name, *source.required)), check_unique(parent, f"{name}_duplicate_{source.key}", [source.key])]
    for child in source.children:
        table, rows = child.table.split("/")[-1], tables[child.table]
        order = next(c for c in rows.columns if c.endswith("_order"))
        if child.required:
            results.append(check(rows, not_null(table, *child.required)))
        results.append(check_unique(rows, f"{table}_duplicate_{order}", [source.key, order]))
        results.append(check_parent(rows, parent, f"{table}_orphan", source.key, source.key))
    return results


def source_checks(wh: Warehouse | Snapshot, source: Source) -> DataFrame:
    """All rules of a source over its whole tables."""
    tables = {name: wh.read(name, schema) for name, schema in source.schemas()}
    rules = check(tables[source.table], source.rules())
    return reduce(DataFrame.unionByName, [rules, *constraints(source, tables)])


def quality_report(wh: Warehouse, names: list[str] | None = None) -> DataFrame:
    now = wh.snapshot()
    return all_checks([source_checks(now, SOURCES[n]) for n in names or list(SOURCES)])


def run(
    wh: Warehouse,
    collections: Mapping[str, DataFrame],
    run_ts: datetime,
    lookback_days: int | None = None,
    run_id: str | None = None,
) -> dict[str, MergeCounts]:
    """One incremental run over the given collections.

    A batch that breaks a constraint is not committed. If a rule fails after the merge, the merged rows stay but no
    watermark moves: the next run extracts the same rows again and merging them once more changes nothing.
    """
    log = RunLog(wh, run_id or new_run_id())
    watermarks = seed_watermarks(wh, {n: SOURCES[n].spec.watermark_field for n in collections})
    results: dict[str, MergeCounts] = {}
    batches: dict[str, StagedBatch] = {}
    try:
        for name, docs in collections.items():
            source, batch_id = SOURCES[name], batch_name(name, run_ts)
            with log.step("extract", name, batch_id) as counts:
                batch = extract(wh, source, docs, watermarks[name], batch_id, run_ts, lookback_days)
                counts.update(extracted=batch.extracted, staged=batch.loaded)
                check_batch_size(batch.extracted, batch.loaded)
            with log.step("merge", name, batch_name(name, run_ts, "merge")) as counts:
                merged = merge(wh, source, batch_id, run_ts)
                counts.update(inserted=merged.inserted, updated=merged.updated, rejected=merged.rejected)
            batches[name], results[name] = batch, merged
        with log.step("quality"):
            now = wh.snapshot()
            gate(all_checks([check(now.read(s.table, s.schema), s.rules()) for s in map(SOURCES.get, collections)]))
        for name, batch in batches.items():
            with log.step("watermark", name, batch_name(name, run_ts, "watermark")):
                advance_watermark(wh, name, SOURCES[name].spec.watermark_field, batch.newest, watermarks[name], run_ts)
    finally:
        log.flush()
    return results
