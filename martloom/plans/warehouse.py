"""The three document sources of the warehouse: their tables, and documents to typed rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.documents import array_length, blank_to_null, iso_timestamp, parse_document, sub_document
from martloom.functions.times import elapsed_hours, elapsed_seconds
from martloom.operators.quality import Rule, not_null
from martloom.operators.shred import ordered_items
from martloom.sinks.warehouse import HOME
from martloom.sources.documents import SourceSpec

# Ticket states.
DONE = ("resolved", "closed")
OPEN = ("open", "in_progress")

SESSION_DOC = (
    "user_id STRING, start_time STRING, end_time STRING, pages_visited ARRAY<STRING>, "
    "device STRUCT<type: STRING, os: STRING, browser: STRING>, actions ARRAY<STRING>"
)
EVENT_DOC = "timestamp STRING, event_type STRING, details STRUCT<page: STRING, product_id: STRING>"
TICKET_DOC = (
    "user_id STRING, status STRING, issue_type STRING, created_at STRING, updated_at STRING, "
    "messages ARRAY<STRUCT<sender: STRING, message_text: STRING, message_timestamp: STRING>>"
)

USER_SESSIONS = (
    "session_id STRING, user_id STRING, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, "
    "session_duration_seconds INT, device_type STRING, device_os STRING, device_browser STRING, "
    "pages_visited_count INT, actions_count INT, loaded_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)
SESSION_PAGES = "session_id STRING, page_order INT, page_url STRING, loaded_at TIMESTAMP_NTZ"
SESSION_ACTIONS = "session_id STRING, action_order INT, action_name STRING, loaded_at TIMESTAMP_NTZ"
EVENT_LOGS = (
    "event_id STRING, event_timestamp TIMESTAMP_NTZ, event_type STRING, detail_page STRING, "
    "detail_product_id STRING, source_details STRING, loaded_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)
SUPPORT_TICKETS = (
    "ticket_id STRING, user_id STRING, status STRING, issue_type STRING, created_at TIMESTAMP_NTZ, "
    "updated_at TIMESTAMP_NTZ, resolution_time_hours DECIMAL(12,2), message_count INT, is_open BOOLEAN, "
    "loaded_at TIMESTAMP_NTZ, dwh_updated_at TIMESTAMP_NTZ"
)
TICKET_MESSAGES = (
    "ticket_id STRING, message_order INT, sender STRING, message_text STRING, "
    "message_timestamp TIMESTAMP_NTZ, loaded_at TIMESTAMP_NTZ"
)


def home_of(raw: DataFrame) -> list[str]:
    """The column with the home of a row, where a frame has one: it stays beside what is made of the row."""
    return [HOME] if HOME in raw.columns else []


def parsed(raw: DataFrame, key: str, schema: str) -> DataFrame:
    """Documents with their parsed form in ``doc``.

    Coming out of a generator, ``doc`` is parsed once per row: a later filter on a field stays above it,
    where otherwise it would be pushed down together with a second ``from_json``.
    """
    doc = F.struct(parse_document("source_doc", schema).alias("doc"))
    return raw.select(key, "source_doc", *home_of(raw), F.inline(F.array(doc)))


def sessions(raw: DataFrame) -> DataFrame:
    start, end = iso_timestamp(F.col("doc.start_time")), iso_timestamp(F.col("doc.end_time"))
    typed = parsed(raw, "session_id", SESSION_DOC).withColumns({"start_time": start, "end_time": end})
    return typed.select(
        "session_id",
        F.col("doc.user_id").alias("user_id"),
        "start_time",
        "end_time",
        elapsed_seconds(F.col("start_time"), F.col("end_time")).alias("session_duration_seconds"),
        *[F.col(f"doc.device.{f}").alias(f"device_{f}") for f in ("type", "os", "browser")],
        *[array_length(F.col(f"doc.{f}")).alias(f"{f}_count") for f in ("pages_visited", "actions")],
        *home_of(raw),
    )


def session_pages(raw: DataFrame) -> DataFrame:
    return ordered_items(parsed(raw, "session_id", SESSION_DOC), "doc.pages_visited", ["session_id", *home_of(raw)], "page_order", "page_url")


def session_actions(raw: DataFrame) -> DataFrame:
    return ordered_items(parsed(raw, "session_id", SESSION_DOC), "doc.actions", ["session_id", *home_of(raw)], "action_order", "action_name")


def events(raw: DataFrame) -> DataFrame:
    typed = parsed(raw, "event_id", EVENT_DOC)
    return typed.select(
        "event_id",
        iso_timestamp(F.col("doc.timestamp")).alias("event_timestamp"),
        blank_to_null(F.col("doc.event_type")).alias("event_type"),
        F.col("doc.details.page").alias("detail_page"),
        F.col("doc.details.product_id").alias("detail_product_id"),
        sub_document("source_doc", "$.details").alias("source_details"),
        *home_of(raw),
    )


def resolution_hours(status: Column, created: Column, updated: Column) -> Column:
    """Hours from creation to the last update, for finished tickets only."""
    return F.when(status.isin(*DONE), elapsed_hours(created, updated))


def is_open(status: Column) -> Column:
    """False, not null, for an unknown state."""
    return F.coalesce(status.isin(*OPEN), F.lit(False))


def tickets(raw: DataFrame) -> DataFrame:
    created, updated = iso_timestamp(F.col("doc.created_at")), iso_timestamp(F.col("doc.updated_at"))
    typed = parsed(raw, "ticket_id", TICKET_DOC).withColumns({"created_at": created, "updated_at": updated})
    status = F.col("doc.status")
    return typed.select(
        "ticket_id",
        *[F.col(f"doc.{f}").alias(f) for f in ("user_id", "status", "issue_type")],
        "created_at",
        "updated_at",
        resolution_hours(status, F.col("created_at"), F.col("updated_at")).alias("resolution_time_hours"),
        array_length(F.col("doc.messages")).alias("message_count"),
        is_open(status).alias("is_open"),
        *home_of(raw),
    )


def ticket_messages(raw: DataFrame) -> DataFrame:
    items = ordered_items(parsed(raw, "ticket_id", TICKET_DOC), "doc.messages", ["ticket_id", *home_of(raw)], "message_order", "item")
    return items.select(
        "ticket_id",
        "message_order",
        F.col("item.sender").alias("sender"),
        F.col("item.message_text").alias("message_text"),
        iso_timestamp(F.col("item.message_timestamp")).alias("message_timestamp"),
        *home_of(raw),
    )


@dataclass(frozen=True)
class Child:
    table: str
    schema: str
    rows: Callable[[DataFrame], DataFrame]
    required: tuple[str, ...]


@dataclass(frozen=True)
class Source:
    """A source, its parent table and child tables, and the rules its rows must keep."""

    spec: SourceSpec
    table: str
    schema: str
    rows: Callable[[DataFrame], DataFrame]
    modified: str
    required: tuple[str, ...]
    accepted: Callable[[], Column] | None = None
    children: tuple[Child, ...] = ()
    rules: Callable[[], list[Rule]] = list

    @property
    def key(self) -> str:
        return self.spec.key

    def schemas(self) -> list[tuple[str, str]]:
        """Name and schema of the parent table and of each child table."""
        return [(self.table, self.schema), *[(c.table, c.schema) for c in self.children]]


# The names of the checks.
def session_rules() -> list[Rule]:
    late = F.col("end_time").isNotNull() & (F.col("start_time") > F.col("end_time"))
    return [
        *not_null("user_sessions", "session_id"),
        Rule("user_sessions_negative_duration", F.col("session_duration_seconds") < 0),
        Rule("user_sessions_invalid_time_range", late),
    ]


def event_rules() -> list[Rule]:
    return not_null("event_logs", "event_id", "event_type")


def ticket_rules() -> list[Rule]:
    return [
        *not_null("support_tickets", "ticket_id"),
        Rule("support_tickets_invalid_time_range", F.col("updated_at") < F.col("created_at")),
        Rule("support_tickets_negative_resolution", F.col("resolution_time_hours") < 0),
        *not_null("support_tickets", "status"),
    ]


SOURCES = {
    source.spec.name: source
    for source in (
        Source(
            SourceSpec("user_sessions", "session_id", "start_time", "source_start_time"),
            "dwh/user_sessions", USER_SESSIONS, sessions, "updated_at", ("user_id", "start_time"),
            children=(
                Child("dwh/session_pages", SESSION_PAGES, session_pages, ("page_url",)),
                Child("dwh/session_actions", SESSION_ACTIONS, session_actions, ("action_name",)),
            ),
            rules=session_rules,
        ),
        Source(
            SourceSpec("event_logs", "event_id", "timestamp", "source_timestamp"),
            "dwh/event_logs", EVENT_LOGS, events, "updated_at", ("event_timestamp",),
            accepted=lambda: F.col("event_type").isNotNull(),
            rules=event_rules,
        ),
        Source(
            SourceSpec("support_tickets", "ticket_id", "updated_at", "source_updated_at"),
            "dwh/support_tickets", SUPPORT_TICKETS, tickets, "dwh_updated_at",
            ("user_id", "issue_type", "created_at", "updated_at"),
            children=(Child("dwh/ticket_messages", TICKET_MESSAGES, ticket_messages, ()),),
            rules=ticket_rules,
        ),
    )
}
