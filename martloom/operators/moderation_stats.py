"""Mart ``moderation_stats``: review moderation per day and status."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.exact import as_int, as_numeric, instant, mean_2dp


def moderation_stats(reviews: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """One row per (date of ``submitted_at``, moderation status).

    Groups are few and large at any scale. The two distinct counts are planned as
    an aggregation by (group, product) and (group, user), then one by group; all
    steps are combined before they are shuffled.
    """
    stats = (
        review_measures(reviews)
        .groupBy("date", "moderation_status")
        .agg(
            F.count("*").alias("reviews"),
            F.sum("rating").alias("rating_sum"),
            F.count("rating").alias("rated"),
            F.sum("flags").alias("flags"),
            F.count_distinct("product_id").alias("products"),
            F.count_distinct("user_id").alias("users"),
        )
    )
    return moderation_rows(stats, as_of)


def review_measures(reviews: DataFrame) -> DataFrame:
    """(date, moderation_status, rating, flags, product_id, user_id) of each review."""
    return reviews.select(
        F.to_date("submitted_at").alias("date"),
        "moderation_status",
        "rating",
        F.array_size("flags").alias("flags"),
        "product_id",
        "user_id",
    )


def moderation_rows(stats: DataFrame, as_of: datetime | None) -> DataFrame:
    """The mart from the totals of its groups."""
    return stats.select(
        "date",
        "moderation_status",
        as_int(F.col("reviews"), "total_reviews").alias("total_reviews"),
        as_numeric(mean_2dp(F.col("rating_sum"), F.col("rated")), 3, "avg_rating").alias("avg_rating"),
        as_int(F.coalesce("flags", F.lit(0)), "total_flags").alias("total_flags"),
        as_int(F.col("products"), "unique_products").alias("unique_products"),
        as_int(F.col("users"), "unique_users").alias("unique_users"),
        instant(as_of).alias("updated_at"),
    )
