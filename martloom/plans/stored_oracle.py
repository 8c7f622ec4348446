"""DuckDB SQL for the stored tables: the derived rows with the changes of the later batches."""

from __future__ import annotations

from martloom.plans import oracle

_DAYS = {n: f"TIMESTAMP '2024-02-0{n} 00:00:00'" for n in (1, 2, 3)}
#: Rows that each batch holds, by the digit ``h`` of their key, and rows that are there after it.
_IN = {1: "h >= '4'", 2: "h BETWEEN '1' AND '7'", 3: "(h = '0' OR h BETWEEN '2' AND '5')"}
_THERE = {1: "h >= '4'", 2: "h >= '1'", 3: "true"}


def _last(batch: int, old: str, second: str, third: str) -> str:
    """The value of the last batch up to ``batch`` that holds the row."""
    cases = {3: f"WHEN {_IN[3]} THEN {third} ", 2: f"WHEN {_IN[2]} THEN {second} "}
    chosen = "".join(case for n, case in cases.items() if n <= batch)
    return f"CASE {chosen}ELSE {old} END" if chosen else old


def _sticky(column: str) -> str:
    """The value of the first batch that holds the row."""
    return (
        f"CASE WHEN h = '0' THEN {column} + INTERVAL 2 DAY WHEN h < '4' THEN {column} + INTERVAL 1 DAY "
        f"ELSE {column} END AS {column}"
    )


def _stamp(batch: int) -> str:
    return f"{_last(batch, _DAYS[1], _DAYS[2], _DAYS[3])} AS loaded_at"


#: Per derived table its name, key and the columns that batches change.
_PARTS = {
    oracle._SESSIONS: (
        "user_sessions", "session_id",
        lambda n: f"{_sticky('start_time')}, {_last(n, 'device', repr('changed'), repr('again'))} AS device",
    ),
    oracle._TICKETS: (
        "support_tickets", "ticket_id",
        lambda n: f"{_sticky('created_at')}, {_last(n, 'status', repr('closed'), repr('open'))} AS status",
    ),
    oracle._REVIEWS: ("moderation_queue", "review_id", lambda n: f"CAST({_last(n, 'rating', '1', '2')} AS INTEGER) AS rating"),
    oracle._RECOMMENDATIONS: (
        "user_recommendations", "user_id",
        lambda n: f"{_last(n, 'last_updated', 'last_updated + INTERVAL 1 DAY', 'last_updated + INTERVAL 2 DAY')} AS last_updated",
    ),
}


def _after(sql: str, batch: int = 3) -> str:
    """``sql`` over the tables as the batches up to ``batch`` leave them."""
    for part, (name, key, replaced) in _PARTS.items():
        before = part.replace(f"{name} AS (", f"derived_{name} AS (")
        rows = (
            f"{name} AS (SELECT * REPLACE ({replaced(batch)}), {_stamp(batch)} "
            f"FROM (SELECT *, substr(md5({key}), 1, 1) AS h FROM derived_{name}) WHERE {_THERE[batch]})"
        )
        sql = sql.replace(part, f"{before}, {rows}")
    return sql


def _raw(name: str, columns: str, part: str) -> str:
    return _after(f"WITH {part} SELECT {columns}, loaded_at FROM {name}")


_EVENTS = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS timestamp,
       {_last(3, "event_type", "'changed'", "'again'")} AS event_type,
       '{{"k":' || regexp_extract(props, '[0-9]+') || '}}' AS details, {_stamp(3)}
FROM (SELECT *, substr(md5(CAST(event_id AS VARCHAR)), 1, 1) AS h FROM events)"""

_KEYS = f"""
WITH {oracle._SESSIONS}, {oracle._TICKETS}, {oracle._REVIEWS}, {oracle._RECOMMENDATIONS},
keys AS (
  SELECT 'UserSessions' AS collection, 'user_sessions' AS "table", 'session_id' AS name, session_id AS k FROM user_sessions
  UNION ALL SELECT 'EventLogs', 'event_logs', 'event_id', CAST(event_id AS VARCHAR) FROM events
  UNION ALL SELECT 'SupportTickets', 'support_tickets', 'ticket_id', ticket_id FROM support_tickets
  UNION ALL SELECT 'UserRecommendations', 'user_recommendations', 'user_id', user_id FROM user_recommendations
  UNION ALL SELECT 'ModerationQueue', 'moderation_queue', 'review_id', review_id FROM moderation_queue
), digits AS (SELECT *, substr(md5(k), 1, 1) AS h FROM keys)"""

_QUARANTINE = f"""{_KEYS}
SELECT CAST(NULL AS VARCHAR) AS key, 'missing key: ' || name AS reason, '{{"lost":"' || k || '"}}' AS document,
       collection, '20240202T000000000000' AS run
FROM digits WHERE h = 'c'"""

_MART_ROWS = {
    "user_activity": oracle.ORACLE["user_activity"],
    "support_efficiency": oracle.ORACLE["support_efficiency"],
    "moderation_stats": oracle.ORACLE["moderation_stats"],
    "product_popularity": oracle.ORACLE["product_popularity"],
}


def _mart_counts(batch: int) -> dict[str, str]:
    return {name: f"(SELECT count(*) FROM ({_after(sql, batch)}))" for name, sql in _MART_ROWS.items()}


def _loads() -> str:
    made = []
    for n in (1, 2, 3):
        lost = "count(*) FILTER (WHERE h = 'c')" if n == 2 else "CAST(0 AS BIGINT)"
        held = f"count(*) FILTER (WHERE {_IN[n]})"
        made.append(
            f"SELECT {n} AS batch, \"table\", {held} + {lost} AS source, {held} AS accepted, {lost} AS rejected, "
            f'count(*) FILTER (WHERE {_THERE[n]}) AS rows FROM digits GROUP BY "table"'
        )
        made += [f"SELECT {n}, '{name}', NULL, NULL, NULL, {rows}" for name, rows in _mart_counts(n).items()]
    made.append("SELECT 4, 'event_logs', 0, 0, 0, count(*) FROM events")
    made.append("SELECT 5, 'user_recommendations', NULL, NULL, NULL, count(*) FROM user_recommendations")
    return " UNION ALL ".join(made)


_COUNTS = f"""{_KEYS}
SELECT CAST(batch AS INTEGER) AS batch, "table", CAST(source AS BIGINT) AS source, CAST(accepted AS BIGINT) AS accepted,
       CAST(rejected AS BIGINT) AS rejected, rows FROM ({_loads()})"""


def _snapshots() -> str:
    made = []
    for run, batch in ((2, 2), (3, 3), (4, 3)):
        made.append(f'SELECT {run} AS run, "table", count(*) FILTER (WHERE {_THERE[batch]}) AS rows FROM digits GROUP BY "table"')
        made += [f"SELECT {run}, '{name}', {rows}" for name, rows in _mart_counts(batch).items()]
    return " UNION ALL ".join(made)


_SNAPSHOT = f"""{_KEYS}
SELECT CAST(run AS INTEGER) AS run, "table", rows FROM ({_snapshots()})"""

_ORDER = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(DISTINCT date) AS dates, CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS overlaps "
    f"FROM ({_after(sql)})"
    for name, sql in _MART_ROWS.items()
)

_AGAIN = f"""{_KEYS}
SELECT "table", CAST(rows AS BIGINT) AS rows, CAST(0 AS BIGINT) AS changed FROM (
  SELECT "table", count(*) AS rows FROM digits GROUP BY "table" UNION ALL
  {" UNION ALL ".join(f"SELECT '{name}', {rows}" for name, rows in _mart_counts(3).items())})"""

ORACLE = {
    "stored_user_sessions": _raw(
        "user_sessions",
        f"session_id, user_id, start_time, end_time, {oracle._joined('pages_visited')} AS pages_visited, device, "
        f"{oracle._joined('actions')} AS actions",
        oracle._SESSIONS,
    ),
    "stored_event_logs": _EVENTS,
    "stored_support_tickets": _raw(
        "support_tickets",
        "ticket_id, user_id, status, issue_type, coalesce(messages, '[]') AS messages, created_at, updated_at",
        oracle._TICKETS,
    ),
    "stored_user_recommendations": _raw(
        "user_recommendations",
        f"user_id, {oracle._joined('recommended_products')} AS recommended_products, last_updated",
        oracle._RECOMMENDATIONS,
    ),
    "stored_moderation_queue": _raw("moderation_queue", oracle._REVIEW_COLUMNS, oracle._REVIEWS),
    **{
        f"stored_{name}": f"SELECT *, {_DAYS[3]} AS updated_at FROM ({_after(sql)})"
        for name, sql in _MART_ROWS.items()
    },
    **{f"updated_{name}": _after(sql) for name, sql in _MART_ROWS.items()},
    "stored_quarantine": _QUARANTINE,
    "stored_snapshot": _SNAPSHOT,
    "stored_order": _ORDER,
    "stored_again": _AGAIN,
    "load_counts": _COUNTS,
}
