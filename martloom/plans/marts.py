"""Marts over the warehouse, and the reports read from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.aggregates import distribution, mode, mode_rank, rounded_avg, sum_or_zero
from martloom.operators.merge import ACTION, upsert
from martloom.plans.warehouse import SUPPORT_TICKETS, USER_SESSIONS
from martloom.session import workspace
from martloom.sinks.runlog import RunLog
from martloom.sinks.warehouse import HOME, Snapshot, Warehouse, local_rows, touched_slices

# Columns of the marts.
USER_ACTIVITY = (
    "user_id STRING, total_sessions BIGINT, avg_session_duration_seconds DECIMAL(12,2), total_pages_visited BIGINT, "
    "total_actions BIGINT, last_session_at TIMESTAMP_NTZ, favorite_device_type STRING, updated_at TIMESTAMP_NTZ"
)
USER_DEVICE = (
    "user_id STRING, device_type STRING, n BIGINT, seconds BIGINT, timed BIGINT, pages BIGINT, actions BIGINT, last TIMESTAMP_NTZ"
)
PROGRESS = "mart STRING, seq BIGINT"
SUMS = ("n", "seconds", "timed", "pages", "actions")
SUPPORT_EFFICIENCY = (
    "ticket_id STRING, user_id STRING, issue_type STRING, status STRING, created_at TIMESTAMP_NTZ, "
    "updated_at TIMESTAMP_NTZ, resolution_time_hours DECIMAL(12,2), message_count INT, is_open BOOLEAN"
)


def by_device(sessions: DataFrame, sign: Column | None = None) -> DataFrame:
    """Sums by (user, device). With a sign, rows count for 1 or -1, and both newest times are kept apart."""
    one = F.lit(1) if sign is None else sign
    measures = [
        F.sum(one.cast("bigint")).alias("n"),
        F.sum(one * F.col("session_duration_seconds").cast("bigint")).alias("seconds"),
        F.sum(F.when(F.col("session_duration_seconds").isNotNull(), one).otherwise(0).cast("bigint")).alias("timed"),
        F.sum(one * F.col("pages_visited_count").cast("bigint")).alias("pages"),
        F.sum(one * F.col("actions_count").cast("bigint")).alias("actions"),
    ]
    if sign is None:
        return sessions.groupBy("user_id", "device_type").agg(*measures, F.max("start_time").alias("last"))
    came, went = (F.max(F.when(sign == s, F.col("start_time"))) for s in (1, -1))
    return sessions.groupBy("user_id", "device_type").agg(*measures, came.alias("came"), went.alias("went"))


def of_devices(devices: DataFrame) -> DataFrame:
    """Totals and favourite device per user, from the sums by device."""
    favorite = F.min_by("device_type", mode_rank("device_type", F.col("n")))
    average = F.sum("seconds").cast("decimal(24,2)") / F.nullif(F.sum("timed"), F.lit(0)).cast("decimal(12,0)")
    return devices.groupBy("user_id").agg(
        F.sum("n").alias("total_sessions"),
        F.round(average, 2).cast("decimal(12,2)").alias("avg_session_duration_seconds"),
        sum_or_zero("pages").alias("total_pages_visited"),
        sum_or_zero("actions").alias("total_actions"),
        F.max("last").alias("last_session_at"),
        favorite.alias("favorite_device_type"),
    )


def user_activity(sessions: DataFrame) -> DataFrame:
    """Totals and favourite device per user, from one scan and without a join.

    Sessions are first summed by (user, device): that is what the favourite is counted from, the sums add
    up to the totals, and a user with very many sessions arrives at the second step as a few rows.
    """
    return of_devices(by_device(sessions))


def user_activity_joined(sessions: DataFrame) -> DataFrame:
    """The same mart as totals left-joined to favourites, for when favourites are kept as a table."""
    favorites = mode(sessions, ["user_id"], "device_type", "favorite_device_type")
    totals = sessions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        rounded_avg("session_duration_seconds").alias("avg_session_duration_seconds"),
        sum_or_zero("pages_visited_count").alias("total_pages_visited"),
        sum_or_zero("actions_count").alias("total_actions"),
        F.max("start_time").alias("last_session_at"),
    )
    return totals.join(favorites, "user_id", "left")


def support_efficiency(tickets: DataFrame, *more: str) -> DataFrame:
    return tickets.select(
        "ticket_id", "user_id", "issue_type", "status", "created_at", "updated_at",
        "resolution_time_hours", "message_count", "is_open", *more,
    )


def status_distribution(mart: DataFrame) -> DataFrame:
    return distribution(mart, "status", "tickets")


def average_resolution(mart: DataFrame, by: str = "issue_type") -> DataFrame:
    return mart.groupBy(by).agg(rounded_avg("resolution_time_hours").alias("avg_resolution_hours"))


def favorite_devices(mart: DataFrame) -> DataFrame:
    return distribution(mart, "favorite_device_type", "users")


def _activity(wh: Warehouse, run_ts: datetime) -> tuple[int, int]:
    rows = user_activity(wh.read("dwh/user_sessions", USER_SESSIONS))
    return _merge_mart(wh, "mart/user_activity", USER_ACTIVITY, rows, "user_id", run_ts, "updated_at")


def _efficiency(wh: Warehouse, run_ts: datetime) -> tuple[int, int]:
    """Tickets as they are, in the slices of their table."""
    now, table = wh.snapshot(), "mart/support_efficiency"
    rows = support_efficiency(now.read("dwh/support_tickets", SUPPORT_TICKETS, home=True), HOME)
    target = now.read(table, SUPPORT_EFFICIENCY, home=True)
    return _write_mart(now, table, target, rows, "ticket_id", run_ts, None, F.col(HOME), now.slices("dwh/support_tickets"))


MARTS = {"user_activity": _activity, "support_efficiency": _efficiency}


def build(wh: Warehouse, run_ts: datetime, names: Sequence[str] = tuple(MARTS)) -> None:
    """Recompute the named marts and merge them in, counts logged; rows of the marts are never deleted."""
    unknown = set(names) - set(MARTS)
    if unknown:
        raise ValueError(f"no such mart: {sorted(unknown)}")
    log = RunLog(wh)
    try:
        for name in names:
            with log.step("build_mart", name) as counts:
                inserted, updated = MARTS[name](wh, run_ts)
                counts.update(inserted=inserted, updated=updated)
    finally:
        log.flush()


def _merge_mart(
    wh: Warehouse, table: str, schema: str, rows: DataFrame, key: str, run_ts: datetime, modified: str | None
) -> tuple[int, int]:
    now = wh.snapshot()
    return _write_mart(now, table, now.read(table, schema), rows, key, run_ts, modified, wh.key_slice(key), range(wh.slices))


def _merged(
    now: Snapshot, table: str, target: DataFrame, rows: DataFrame, key: str, run_ts: datetime, modified: str | None, slice_of: Column
) -> tuple[str, int, int]:
    """The version written, and rows inserted and updated, counted in what was written."""
    wh = now.wh
    columns = [c for c in rows.columns if c not in (key, HOME)]
    merged = upsert(target, rows, [key], columns, run_ts, modified=modified, with_action=True)
    version = f"{run_ts.strftime('%Y%m%dT%H%M%S')}-{now.next_seq}"
    wh.write_version(merged, table, version, slice_of)
    found = wh.read_version(table, version, f"{ACTION} STRING").groupBy(ACTION).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {row[ACTION]: row.n for row in found}
    return version, counts.get("insert", 0), counts.get("update", 0)


def _write_mart(
    now: Snapshot, table: str, target: DataFrame, rows: DataFrame, key: str, run_ts: datetime, modified: str | None,
    slice_of: Column, replaced: Sequence[int],
) -> tuple[int, int]:
    version, inserted, updated = _merged(now, table, target, rows, key, run_ts, modified, slice_of)
    if replaced:
        now.wh.commit(now.next_seq, version, [table], replaced, run_ts)
    return inserted, updated


# ---- marts kept up by what changed ---------------------------------------------------------------------


def refresh(wh: Warehouse, run_ts: datetime, names: Sequence[str] = tuple(MARTS)) -> None:
    """Bring the named marts up to date from the slices that changed since their last refresh, counts logged.

    The result is that of ``build``, except that only rows of which something changed get a new stamp.
    """
    unknown = set(names) - set(MARTS)
    if unknown:
        raise ValueError(f"no such mart: {sorted(unknown)}")
    log = RunLog(wh)
    try:
        for name in names:
            with log.step("refresh_mart", name) as counts:
                inserted, updated = REFRESHED[name](wh, run_ts)
                counts.update(inserted=inserted, updated=updated)
    finally:
        log.flush()


def _applied(now: Snapshot, mart: str) -> int:
    """The last commit a mart has taken in; 0 before its first refresh."""
    row = now.read(f"meta_{mart}/progress", PROGRESS).first()
    return 0 if row is None else row.seq


def _note_progress(wh: Warehouse, mart: str, seq: int, version: str) -> dict[str, tuple[list[int], list[int]]]:
    table = f"meta_{mart}/progress"
    wh.write_version(local_rows(wh.spark, [(mart, seq)], PROGRESS), table, version, F.lit(0))
    return {table: ([0], [])}


def session_delta(before: Snapshot, now: Snapshot, slices: Sequence[int]) -> DataFrame:
    """Signed sums by (user, device) of what some slices held before and hold now: what stayed cancels out.

    Sessions that moved to another user or device are taken back there and added here. ``went`` and ``came`` are the
    newest times before and now.
    """
    table = "dwh/user_sessions"
    gone = before.read(table, USER_SESSIONS, slices).withColumn("sign", F.lit(-1))
    here = now.read(table, USER_SESSIONS, slices).withColumn("sign", F.lit(1))
    delta = by_device(gone.unionByName(here), F.col("sign"))
    same = [F.coalesce(F.col(c), F.lit(0)) == 0 for c in SUMS] + [F.col("came").eqNullSafe(F.col("went"))]
    return delta.where(~reduce(Column.__and__, same))


def corrected(devices: DataFrame, delta: DataFrame) -> DataFrame:
    """Stored sums with a delta added; those without sessions go. ``changed`` marks groups of the delta.

    ``lost`` marks groups whose newest session was taken back without one as new coming in: their newest
    time lies in slices that the delta does not know.
    """
    fresh = delta.withColumnsRenamed({c: f"_{c}" for c in delta.columns})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in ("user_id", "device_type")]
    both = devices.withColumn("_stored", F.lit(True)).join(fresh.withColumn("_arrived", F.lit(True)), on, "full_outer")
    stored, arrived = F.col("_stored").isNotNull(), F.col("_arrived").isNotNull()
    keys = [F.when(stored, F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in ("user_id", "device_type")]
    sums = [(F.coalesce(c, F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in SUMS]
    went = F.col("_went").isNotNull() & (F.col("_went") == F.col("last"))
    lost = went & (F.col("_came").isNull() | (F.col("_came") < F.col("_went")))
    marks = [F.coalesce(lost, F.lit(False)).alias("lost"), arrived.alias("changed")]
    return both.select(*keys, *sums, F.greatest("last", "_came").alias("last"), *marks).where("n > 0")


def _with_found_times(devices: DataFrame, sessions: DataFrame) -> DataFrame:
    """Newest times of lost groups, found among the sessions of these groups."""
    lost = devices.where("lost").select(F.col("user_id").alias("_u"), F.col("device_type").alias("_d"))
    of_group = F.col("user_id").eqNullSafe(F.col("_u")) & F.col("device_type").eqNullSafe(F.col("_d"))
    found = sessions.join(lost, of_group).groupBy("_u", "_d").agg(F.max("start_time").alias("_last"))
    newest = F.when(F.col("lost"), F.col("_last")).otherwise(F.col("last"))
    return devices.join(found, of_group, "left").withColumn("last", newest).drop("_u", "_d", "_last")


def _refresh_activity(wh: Warehouse, run_ts: datetime) -> tuple[int, int]:
    now, sessions, devices, mart = wh.snapshot(), "dwh/user_sessions", "mart/user_device", "mart/user_activity"
    applied = _applied(now, "user_activity")
    slices = wh.changed_since(sessions, applied)
    if not slices:
        return 0, 0
    path = workspace(wh.spark, "session-delta")
    session_delta(wh.snapshot(until=applied), now, slices).write.parquet(path)
    delta = wh.spark.read.parquet(path)
    user_slice = wh.key_slice("user_id")
    users = touched_slices(delta, user_slice)

    version = f"{run_ts.strftime('%Y%m%dT%H%M%S')}-{now.next_seq}"
    marked = f"{USER_DEVICE}, lost BOOLEAN, changed BOOLEAN"
    path = workspace(wh.spark, "user-devices")
    corrected(now.read(devices, USER_DEVICE, users), delta).write.parquet(path)
    sums = wh.spark.read.schema(marked).parquet(path)
    if not sums.where("lost").isEmpty():
        sums = _with_found_times(sums, now.read(sessions, USER_SESSIONS))
    wh.write_version(sums, devices, version, user_slice)

    current = wh.read_version(devices, version, marked)
    changed = delta.select(F.col("user_id").alias("_u")).distinct()
    rows = of_devices(current.join(changed, F.col("user_id").eqNullSafe(F.col("_u")), "left_semi"))
    target = now.read(mart, USER_ACTIVITY, users)
    written, inserted, updated = _merged(now, mart, target, rows, "user_id", run_ts, "updated_at", user_slice)
    progress = _note_progress(wh, "user_activity", now.next_seq - 1, written)
    wh.commit(now.next_seq, written, [devices, mart], users, run_ts, others=progress)
    return inserted, updated


def _refresh_efficiency(wh: Warehouse, run_ts: datetime) -> tuple[int, int]:
    now, mart = wh.snapshot(), "mart/support_efficiency"
    slices = wh.changed_since("dwh/support_tickets", _applied(now, "support_efficiency"))
    if not slices:
        return 0, 0
    rows = support_efficiency(now.read("dwh/support_tickets", SUPPORT_TICKETS, slices, home=True), HOME)
    target = now.read(mart, SUPPORT_EFFICIENCY, slices, home=True)
    version, inserted, updated = _merged(now, mart, target, rows, "ticket_id", run_ts, None, F.col(HOME))
    progress = _note_progress(wh, "support_efficiency", now.next_seq - 1, version)
    wh.commit(now.next_seq, version, [mart], slices, run_ts, others=progress)
    return inserted, updated


REFRESHED = {"user_activity": _refresh_activity, "support_efficiency": _refresh_efficiency}
