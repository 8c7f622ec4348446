"""Declared shape of the five raw tables and the four marts.

Nothing is ever inferred: every reader, writer, parser and check is driven by
the specs below.
"""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import types as T

_NTZ = T.TimestampNTZType()
_STRINGS = T.ArrayType(T.StringType())


class Kind(Enum):
    """How a document value becomes a column value."""

    TEXT = "text"
    TIME = "time"
    JSON = "json"
    TEXT_ARRAY = "text array"
    INTEGER = "integer"

    @property
    def spark_type(self) -> T.DataType:
        return {
            Kind.TEXT: T.StringType(),
            Kind.TIME: _NTZ,
            Kind.JSON: T.StringType(),
            Kind.TEXT_ARRAY: _STRINGS,
            Kind.INTEGER: T.IntegerType(),
        }[self]


# Marks a key with no default: when it is absent the column is NULL.
NO_DEFAULT = object()


@dataclass(frozen=True)
class RawColumn:
    """One column of a raw table and the document key (same name) that feeds it.

    ``required``  an absent key rejects the document
    ``default``   value for an absent key; an explicit null stays null
    ``not_null``  a null that gets this far fails the whole batch
    ``sticky``    keeps the first value ever loaded for its row key
    """

    name: str
    kind: Kind
    required: bool = False
    default: object = NO_DEFAULT
    not_null: bool = False
    sticky: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class RawTable:
    name: str
    collection: str
    key: str
    columns: tuple[RawColumn, ...]

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.key,)

    @property
    def sticky(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if c.sticky)

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(c.name, c.kind.spark_type) for c in self.columns]
        return T.StructType([*fields, T.StructField("loaded_at", _NTZ)])

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if c.not_null)

    @property
    def max_lengths(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length is not None}

    @property
    def json_arrays(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if c.kind is Kind.JSON and c.default == "[]")


@dataclass(frozen=True)
class MartTable:
    """A mart is keyed by ``(date, <second key>)``.

    ``by_date``: a directory per date. For marts with many rows a day; one with a
    handful would turn into as many small files as there are dates.
    """

    name: str
    keys: tuple[str, str]
    schema: T.StructType
    max_lengths: dict[str, int]
    by_date: bool

    @property
    def not_null(self) -> tuple[str, ...]:
        return self.keys

    @property
    def json_arrays(self) -> tuple[str, ...]:
        return ()


def _key(name: str) -> RawColumn:
    return RawColumn(name, Kind.TEXT, required=True, not_null=True, max_length=50)


# Collection names, keys, defaults and lengths of the raw tables.
USER_SESSIONS = RawTable(
    "user_sessions",
    "UserSessions",
    "session_id",
    (
        _key("session_id"),
        RawColumn("user_id", Kind.TEXT, required=True, not_null=True, max_length=50),
        RawColumn("start_time", Kind.TIME, required=True, not_null=True, sticky=True),
        RawColumn("end_time", Kind.TIME),
        RawColumn("pages_visited", Kind.TEXT_ARRAY, default=()),
        RawColumn("device", Kind.TEXT, default="unknown", max_length=50),
        RawColumn("actions", Kind.TEXT_ARRAY, default=()),
    ),
)

EVENT_LOGS = RawTable(
    "event_logs",
    "EventLogs",
    "event_id",
    (
        _key("event_id"),
        RawColumn("timestamp", Kind.TIME, required=True, not_null=True),
        RawColumn("event_type", Kind.TEXT, default="unknown", max_length=50),
        RawColumn("details", Kind.JSON, default="{}"),
    ),
)

SUPPORT_TICKETS = RawTable(
    "support_tickets",
    "SupportTickets",
    "ticket_id",
    (
        _key("ticket_id"),
        RawColumn("user_id", Kind.TEXT, required=True, not_null=True, max_length=50),
        RawColumn("status", Kind.TEXT, default="unknown", max_length=20),
        RawColumn("issue_type", Kind.TEXT, default="unknown", max_length=50),
        RawColumn("messages", Kind.JSON, default="[]"),
        RawColumn("created_at", Kind.TIME, required=True, sticky=True),
        RawColumn("updated_at", Kind.TIME),
    ),
)

USER_RECOMMENDATIONS = RawTable(
    "user_recommendations",
    "UserRecommendations",
    "user_id",
    (
        _key("user_id"),
        RawColumn("recommended_products", Kind.TEXT_ARRAY, default=()),
        RawColumn("last_updated", Kind.TIME),
    ),
)

MODERATION_QUEUE = RawTable(
    "moderation_queue",
    "ModerationQueue",
    "review_id",
    (
        _key("review_id"),
        RawColumn("user_id", Kind.TEXT, max_length=50),
        RawColumn("product_id", Kind.TEXT, max_length=50),
        RawColumn("review_text", Kind.TEXT, default=""),
        RawColumn("rating", Kind.INTEGER, default=0),
        RawColumn("moderation_status", Kind.TEXT, default="pending", max_length=20),
        RawColumn("flags", Kind.TEXT_ARRAY, default=()),
        RawColumn("submitted_at", Kind.TIME),
    ),
)

RAW_TABLES = {
    t.name: t
    for t in (USER_SESSIONS, EVENT_LOGS, SUPPORT_TICKETS, USER_RECOMMENDATIONS, MODERATION_QUEUE)
}

# Columns, key and lengths of the marts.
USER_ACTIVITY = MartTable(
    "user_activity",
    ("date", "user_id"),
    T.StructType()
    .add("date", "date")
    .add("user_id", "string")
    .add("total_sessions", "integer")
    .add("avg_session_duration_minutes", "decimal(10,2)")
    .add("total_pages_visited", "integer")
    .add("unique_pages_visited", "integer")
    .add("total_actions", "integer")
    .add("most_frequent_action", "string")
    .add("devices_used", _STRINGS)
    .add("last_activity", _NTZ)
    .add("updated_at", _NTZ),
    {"user_id": 50, "most_frequent_action": 50},
    by_date=True,
)

SUPPORT_EFFICIENCY = MartTable(
    "support_efficiency",
    ("date", "issue_type"),
    T.StructType()
    .add("date", "date")
    .add("issue_type", "string")
    .add("total_tickets", "integer")
    .add("open_tickets", "integer")
    .add("closed_tickets", "integer")
    .add("avg_resolution_time_hours", "decimal(10,2)")
    .add("max_resolution_time_hours", "decimal(10,2)")
    .add("min_resolution_time_hours", "decimal(10,2)")
    .add("total_messages", "integer")
    .add("unique_users", "integer")
    .add("updated_at", _NTZ),
    {"issue_type": 50},
    by_date=False,
)

MODERATION_STATS = MartTable(
    "moderation_stats",
    ("date", "moderation_status"),
    T.StructType()
    .add("date", "date")
    .add("moderation_status", "string")
    .add("total_reviews", "integer")
    .add("avg_rating", "decimal(3,2)")
    .add("total_flags", "integer")
    .add("unique_products", "integer")
    .add("unique_users", "integer")
    .add("updated_at", _NTZ),
    {"moderation_status": 20},
    by_date=False,
)

PRODUCT_POPULARITY = MartTable(
    "product_popularity",
    ("date", "product_id"),
    T.StructType()
    .add("date", "date")
    .add("product_id", "string")
    .add("total_views", "integer")
    .add("total_reviews", "integer")
    .add("avg_rating", "decimal(3,2)")
    .add("times_recommended", "integer")
    .add("updated_at", _NTZ),
    {"product_id": 50},
    by_date=True,
)

MARTS = {
    m.name: m for m in (USER_ACTIVITY, SUPPORT_EFFICIENCY, MODERATION_STATS, PRODUCT_POPULARITY)
}
