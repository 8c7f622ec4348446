"""Mart ``user_activity``: what each user did on each day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.exact import (
    MICROS_PER_MINUTE,
    as_int,
    as_numeric,
    instant,
    mean_2dp,
    micros_between,
)

COUNTINGS = ("product", "plain")


def user_activity(
    sessions: DataFrame, counting: str = "product", as_of: datetime | None = None
) -> DataFrame:
    """One row per (date of ``start_time``, user).

    ``counting="product"`` (default) weighs every session as if its pages were
    crossed with its actions: a session with p pages and a actions counts
    max(p, 1) * max(a, 1) times in the totals and in the mean duration, and each
    of its actions max(p, 1) times in the most frequent one. ``"plain"`` counts
    each session once. The product itself is never built: its sums follow from
    the two array sizes, so 10^4 pages and 10^4 actions are 2 * 10^4 rows.

    Plan: one scan and one explode to (date, user, kind, item) with kind session
    (item = device), page or action; then two aggregations. The first, by item,
    removes duplicates and spreads a hot user over all tasks; the second sees one
    row per distinct item and has a partial step before its shuffle.
    """
    items = activity_items(sessions, counting)
    by_item = items.groupBy("date", "user_id", "kind", "item").agg(
        *[F.sum(c).alias(c) for c in ("copies", "micros", "timed", "pages", "actions")],
        F.max("end_time").alias("end_time"),
    )
    return activity_rows(by_item, as_of)


def activity_items(sessions: DataFrame, counting: str) -> DataFrame:
    """(date, user_id, kind, item, measures): a row a session, page and action."""
    if counting not in COUNTINGS:
        raise ValueError(f"counting must be one of {COUNTINGS}, not {counting!r}")

    strings = "array<string>"
    pages = F.coalesce(F.col("pages_visited"), F.array().cast(strings))
    actions = F.coalesce(F.col("actions"), F.array().cast(strings))
    n_pages, n_actions = F.col("n_pages"), F.col("n_actions")

    measured = sessions.select(
        F.to_date("start_time").alias("date"),
        "user_id",
        "end_time",
        micros_between(F.col("start_time"), F.col("end_time")).alias("micros"),
        F.size(pages).cast("bigint").alias("n_pages"),
        F.size(actions).cast("bigint").alias("n_actions"),
        F.concat(F.array("device"), pages, actions).alias("items"),
    )
    if counting == "product":
        per_action = F.greatest(n_pages, F.lit(1))
        per_session = per_action * F.greatest(n_actions, F.lit(1))
    else:
        per_action = per_session = F.lit(1).cast("bigint")

    exploded = measured.select(
        "date",
        "user_id",
        "end_time",
        "micros",
        "n_pages",
        "n_actions",
        # There always is a first item; "outer" only spares the inferred test for it.
        F.posexplode_outer("items").alias("pos", "item"),
    )
    is_session = F.col("pos") == 0
    is_action = F.col("pos") > n_pages

    def of_session(value: Column) -> Column:
        return F.when(is_session, value)

    return exploded.select(
        "date",
        "user_id",
        F.when(is_session, "session").when(is_action, "action").otherwise("page").alias("kind"),
        "item",
        F.when(is_session, 1).when(is_action, per_action).alias("copies"),
        of_session(F.col("micros") * per_session.cast("decimal(18,0)")).alias("micros"),
        of_session(F.when(F.col("micros").isNotNull(), per_session)).alias("timed"),
        of_session(n_pages * per_session).alias("pages"),
        of_session(n_actions * per_session).alias("actions"),
        of_session(F.col("end_time")).alias("end_time"),
    )


def activity_rows(by_item: DataFrame, as_of: datetime | None) -> DataFrame:
    """The mart from its items, each of them once in its (date, user, kind)."""
    # Most copies first, then the smallest action in byte order.
    by_user = by_item.groupBy("date", "user_id").agg(
        F.expr("sum(copies) FILTER (WHERE kind = 'session')").alias("sessions"),
        *[F.sum(c).alias(c) for c in ("micros", "timed", "pages", "actions")],
        F.expr("count(item) FILTER (WHERE kind = 'page')").alias("unique_pages"),
        F.expr(
            "min_by(item, struct(-copies, item)) FILTER (WHERE kind = 'action' AND item IS NOT NULL)"
        ).alias("action"),
        F.expr("collect_list(item) FILTER (WHERE kind = 'session')").alias("devices"),
        F.bool_or((F.col("kind") == "session") & F.col("item").isNull()).alias("unnamed_device"),
        F.max("end_time").alias("end_time"),
    )

    mean = F.coalesce(
        mean_2dp(F.col("micros"), F.col("timed"), MICROS_PER_MINUTE), F.lit(0).cast("decimal(10,2)")
    )
    named = F.array_sort("devices")
    unnamed = F.array(F.lit(None).cast("string"))
    return by_user.select(
        "date",
        "user_id",
        as_int(F.col("sessions"), "total_sessions").alias("total_sessions"),
        as_numeric(mean, 10, "avg_session_duration_minutes").alias("avg_session_duration_minutes"),
        as_int(F.col("pages"), "total_pages_visited").alias("total_pages_visited"),
        as_int(F.col("unique_pages"), "unique_pages_visited").alias("unique_pages_visited"),
        as_int(F.col("actions"), "total_actions").alias("total_actions"),
        F.col("action").alias("most_frequent_action"),
        F.when(F.col("unnamed_device"), F.concat(named, unnamed))
        .otherwise(named)
        .alias("devices_used"),
        F.col("end_time").alias("last_activity"),
        instant(as_of).alias("updated_at"),
    )


def session_durations(sessions: DataFrame) -> DataFrame:
    """Length of each session in minutes, two decimals; NULL while it is open."""
    micros = micros_between(F.col("start_time"), F.col("end_time"))
    return sessions.select(
        "session_id",
        micros.cast("bigint").alias("micros"),
        as_numeric(mean_2dp(micros, F.lit(1), MICROS_PER_MINUTE), 10, "minutes").alias("minutes"),
    )
