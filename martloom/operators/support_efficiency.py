"""Mart ``support_efficiency``: ticket load and resolution times per issue type."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.exact import (
    MICROS_PER_HOUR,
    as_int,
    as_numeric,
    instant,
    mean_2dp,
    micros_between,
)


def message_count(messages: Column) -> Column:
    """Length of a JSON array; 0 for NULL, an error for any other JSON value."""
    length = F.json_array_length(messages)
    return F.when(messages.isNull(), F.lit(0)).otherwise(
        F.coalesce(
            length, F.raise_error(F.concat(F.lit("messages: not a JSON array: "), messages)).cast("int")
        )
    )


def support_efficiency(tickets: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One row per (date of ``created_at``, issue type).

    A resolution time exists for closed tickets updated after their creation.
    There are few groups and any of them may be hot: Spark plans the single
    distinct count as an aggregation by (group, user) before the one by group,
    so a hot group is spread by user and the sums are combined on the way.
    """
    rows = ticket_measures(tickets)
    stats = rows.groupBy("date", "issue_type").agg(
        F.count("*").alias("tickets"),
        F.count_if("open").alias("open"),
        F.count_if("closed").alias("closed"),
        F.sum("micros").alias("sum_micros"),
        F.count("micros").alias("resolved"),
        F.max("micros").alias("max_micros"),
        F.min("micros").alias("min_micros"),
        F.sum("messages").alias("messages"),
        F.count_distinct("user_id").alias("users"),
    )
    return support_rows(stats, as_of)


def ticket_measures(tickets: DataFrame) -> DataFrame:
    """(date, issue_type, user_id, open, closed, micros, messages) of each ticket."""
    closed = F.col("status") == "closed"
    resolved = closed & (F.col("updated_at") > F.col("created_at"))
    return tickets.select(
        F.to_date("created_at").alias("date"),
        "issue_type",
        "user_id",
        (F.col("status") == "open").alias("open"),
        closed.alias("closed"),
        F.when(resolved, micros_between(F.col("created_at"), F.col("updated_at"))).alias("micros"),
        message_count(F.col("messages")).alias("messages"),
    )


def support_rows(stats: DataFrame, as_of: datetime | None) -> DataFrame:
    """The mart from the totals of its groups."""

    def hours(total: str, count: Column, name: str) -> Column:
        value = mean_2dp(F.col(total), count, MICROS_PER_HOUR)
        value = F.coalesce(value, F.lit(0).cast("decimal(10,2)"))
        return as_numeric(value, 10, name).alias(name)

    return stats.select(
        "date",
        "issue_type",
        as_int(F.col("tickets"), "total_tickets").alias("total_tickets"),
        as_int(F.col("open"), "open_tickets").alias("open_tickets"),
        as_int(F.col("closed"), "closed_tickets").alias("closed_tickets"),
        hours("sum_micros", F.col("resolved"), "avg_resolution_time_hours"),
        hours("max_micros", F.lit(1), "max_resolution_time_hours"),
        hours("min_micros", F.lit(1), "min_resolution_time_hours"),
        as_int(F.col("messages"), "total_messages").alias("total_messages"),
        as_int(F.col("users"), "unique_users").alias("unique_users"),
        instant(as_of).alias("updated_at"),
    )
