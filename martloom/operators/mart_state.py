"""Partial sums from which a mart's rows follow, and which later changes are added to.

A state has a row per group and value: how often the value occurs, and sums of measures. A
changed source row adds what it now contributes and takes away what it did. So a state can
be kept up from changed rows alone, in any order and split, and it stays exact:

* sums and counts are added up, with a minus sign for what is taken away;
* distinct counts are counts of the values that still occur;
* the most frequent value, the largest and the smallest are chosen among the values that
  still occur, which a mere maximum could not take back.

Rows whose sums are all zero are left out, so a group without source rows disappears.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators import product_popularity as popularity
from martloom.operators.moderation_stats import moderation_rows, review_measures
from martloom.operators.support_efficiency import support_rows, ticket_measures
from martloom.operators.user_activity import activity_items, activity_rows
from martloom.schemas import (
    MODERATION_QUEUE,
    MODERATION_STATS,
    PRODUCT_POPULARITY,
    SUPPORT_EFFICIENCY,
    SUPPORT_TICKETS,
    USER_ACTIVITY,
    USER_RECOMMENDATIONS,
    USER_SESSIONS,
    MartTable,
    RawTable,
)


@dataclass(frozen=True)
class StateTable:
    """``keys`` name a row, ``sums`` are added up; all columns are in ``schema``."""

    name: str
    keys: tuple[str, ...]
    sums: tuple[str, ...]
    schema: T.StructType


def _state(name: str, keys: dict[str, str], sums: dict[str, str]) -> StateTable:
    schema = T.StructType()
    for column, kind in (keys | sums).items():
        schema.add(column, kind)
    return StateTable(name, tuple(keys), tuple(sums), schema)


def summed(rows: DataFrame, state: StateTable) -> DataFrame:
    """One row per key, without those that have come to nothing."""
    total = rows.groupBy(*state.keys).agg(
        *[F.sum(c).cast(state.schema[c].dataType).alias(c) for c in state.sums]
    )
    left = F.lit(False)
    for c in state.sums:
        left = left | (F.col(c) != 0)
    return total.where(left)


def signed(rows: DataFrame, state: StateTable, sign: int) -> DataFrame:
    """Contributions in the state's columns; absent keys are null, absent sums and nulls 0."""
    keys = [
        (F.col(k) if k in rows.columns else F.lit(None)).cast(state.schema[k].dataType).alias(k)
        for k in state.keys
    ]
    sums = [
        (F.coalesce(F.col(c), F.lit(0)) * F.lit(sign) if c in rows.columns else F.lit(0))
        .cast(state.schema[c].dataType)
        .alias(c)
        for c in state.sums
    ]
    return rows.select(*keys, *sums)


@dataclass(frozen=True)
class MartState:
    """How a mart's state follows from source rows, and its rows from the state."""

    mart: MartTable
    state: StateTable
    sources: dict[RawTable, Callable[[DataFrame], list[DataFrame]]]
    finish: Callable[[DataFrame, datetime | None], DataFrame]

    def contributions(self, table: RawTable, rows: DataFrame, sign: int = 1) -> list[DataFrame]:
        return [signed(part, self.state, sign) for part in self.sources[table](rows)]


def _activity(name: str, counting: str) -> MartState:
    keys = {"date": "date", "user_id": "string", "kind": "string", "item": "string", "end_time": "timestamp_ntz"}
    sums = {"copies": "long", "micros": "decimal(38,0)", "timed": "long", "pages": "long", "actions": "long"}

    def from_sessions(sessions: DataFrame) -> list[DataFrame]:
        items = activity_items(sessions, counting).drop("end_time")
        ends = sessions.where("end_time IS NOT NULL").select(
            F.to_date("start_time").alias("date"), "user_id", F.lit("end").alias("kind"), "end_time", F.lit(1).alias("copies")
        )
        return [items.withColumn("copies", F.coalesce("copies", F.lit(1))), ends]

    return MartState(USER_ACTIVITY, _state(name, keys, sums), {USER_SESSIONS: from_sessions}, activity_rows)


def _support() -> MartState:
    keys = {"date": "date", "issue_type": "string", "kind": "string", "item": "string", "micros": "decimal(18,0)"}
    sums = {"copies": "long", "open": "long", "closed": "long", "sum_micros": "decimal(38,0)", "resolved": "long", "messages": "long"}

    def from_tickets(tickets: DataFrame) -> list[DataFrame]:
        rows = ticket_measures(tickets)
        users = rows.select(
            "date",
            "issue_type",
            F.lit("user").alias("kind"),
            F.col("user_id").alias("item"),
            F.lit(1).alias("copies"),
            F.col("open").cast("int").alias("open"),
            F.col("closed").cast("int").alias("closed"),
            F.col("micros").alias("sum_micros"),
            F.col("micros").isNotNull().cast("int").alias("resolved"),
            "messages",
        )
        times = rows.where("micros IS NOT NULL").select(
            "date", "issue_type", F.lit("time").alias("kind"), "micros", F.lit(1).alias("copies")
        )
        return [users, times]

    def finish(state: DataFrame, as_of: datetime | None) -> DataFrame:
        stats = state.groupBy("date", "issue_type").agg(
            F.expr("sum(copies) FILTER (WHERE kind = 'user')").alias("tickets"),
            *[F.sum(c).alias(c) for c in ("open", "closed", "sum_micros", "resolved", "messages")],
            F.max("micros").alias("max_micros"),
            F.min("micros").alias("min_micros"),
            F.expr("count(item) FILTER (WHERE kind = 'user')").alias("users"),
        )
        return support_rows(stats, as_of)

    return MartState(SUPPORT_EFFICIENCY, _state("support_efficiency_sums", keys, sums), {SUPPORT_TICKETS: from_tickets}, finish)


def _moderation() -> MartState:
    keys = {"date": "date", "moderation_status": "string", "kind": "string", "item": "string"}
    sums = {"copies": "long", "rating_sum": "long", "rated": "long", "flags": "long"}

    def from_reviews(reviews: DataFrame) -> list[DataFrame]:
        rows = review_measures(reviews)
        users = rows.select(
            "date",
            "moderation_status",
            F.lit("user").alias("kind"),
            F.col("user_id").alias("item"),
            F.lit(1).alias("copies"),
            F.col("rating").alias("rating_sum"),
            F.col("rating").isNotNull().cast("int").alias("rated"),
            "flags",
        )
        products = rows.select(
            "date", "moderation_status", F.lit("product").alias("kind"), F.col("product_id").alias("item"), F.lit(1).alias("copies")
        )
        return [users, products]

    def finish(state: DataFrame, as_of: datetime | None) -> DataFrame:
        stats = state.groupBy("date", "moderation_status").agg(
            F.expr("sum(copies) FILTER (WHERE kind = 'user')").alias("reviews"),
            *[F.sum(c).alias(c) for c in ("rating_sum", "rated", "flags")],
            F.expr("count(item) FILTER (WHERE kind = 'product')").alias("products"),
            F.expr("count(item) FILTER (WHERE kind = 'user')").alias("users"),
        )
        return moderation_rows(stats, as_of)

    return MartState(MODERATION_STATS, _state("moderation_stats_sums", keys, sums), {MODERATION_QUEUE: from_reviews}, finish)


def _popularity() -> MartState:
    keys = {"date": "date", "product_id": "string", "undated": "integer"}
    sums = {"copies": "long"} | {m: "long" for m in popularity.MEASURES}

    def counted(measures: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], list[DataFrame]]:
        return lambda rows: [measures(rows).withColumn("copies", F.lit(1))]

    sources = {
        USER_SESSIONS: counted(popularity.view_measures),
        MODERATION_QUEUE: counted(popularity.review_measures),
        USER_RECOMMENDATIONS: counted(popularity.recommendation_measures),
    }
    return MartState(PRODUCT_POPULARITY, _state("product_popularity_sums", keys, sums), sources, popularity.popularity_rows)


#: By mart and counting; only ``user_activity`` depends on the counting.
MART_STATES: dict[tuple[str, str], MartState] = {
    ("user_activity", "product"): _activity("user_activity_sums", "product"),
    ("user_activity", "plain"): _activity("user_activity_plain_sums", "plain"),
    **{
        (made.mart.name, counting): made
        for made in (_support(), _moderation(), _popularity())
        for counting in ("product", "plain")
    },
}

STATES: dict[str, StateTable] = {m.state.name: m.state for m in MART_STATES.values()}
