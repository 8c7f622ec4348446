"""Mart ``product_popularity``: views, reviews and recommendations per product and day."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.exact import as_int, as_numeric, instant, mean_2dp

# Fixed value: the only prefix taken off a page; all other pages keep their path.
PRODUCT_PREFIX = "^/products/"
MEASURES = ("prefixed_views", "bare_views", "reviews", "rating_sum", "rated", "recommendations")


def strip_prefix(page: Column) -> Column:
    return F.regexp_replace(page, PRODUCT_PREFIX, "")


def _viewed(sessions: DataFrame) -> DataFrame:
    """(date, page), one row per page of a session; NULL pages included."""
    return sessions.filter("pages_visited IS NOT NULL").select(
        F.to_date("start_time").alias("date"), F.explode("pages_visited").alias("page")
    )


def _approved(reviews: DataFrame) -> DataFrame:
    return reviews.filter(F.col("moderation_status") == "approved").select(
        F.to_date("submitted_at").alias("date"), "product_id", "rating"
    )


def _recommended(recommendations: DataFrame) -> DataFrame:
    return recommendations.select(
        F.to_date("last_updated").alias("date"),
        F.explode("recommended_products").alias("product_id"),
    )


def product_views(sessions: DataFrame) -> DataFrame:
    """Views per (date, page). The arrays are exploded in a step of their own:
    grouping by an explode expression would group by whole arrays."""
    return _viewed(sessions).groupBy("date", "page").agg(F.count("*").alias("views"))


def product_reviews(reviews: DataFrame) -> DataFrame:
    """Approved reviews and their mean rating per (date, product)."""
    return (
        _approved(reviews)
        .groupBy("date", "product_id")
        .agg(
            F.count("*").alias("reviews"),
            as_numeric(
                mean_2dp(F.sum("rating"), F.count("rating")), 10, "avg_rating"
            ).alias("avg_rating"),
        )
    )


def product_recommendations(recommendations: DataFrame) -> DataFrame:
    """How often each product was recommended, per date of ``last_updated``."""
    return (
        _recommended(recommendations)
        .groupBy("date", "product_id")
        .agg(F.count("*").alias("recommendations"))
    )


def product_popularity(
    sessions: DataFrame,
    reviews: DataFrame,
    recommendations: DataFrame,
    as_of: datetime | None = None,
) -> DataFrame:
    """One row per (date, product) seen in any of the three sources.

    The three sources are brought to one row shape and aggregated once, with a
    partial step before the only shuffle, in place of three aggregations and two
    full outer joins. Two things keep the result that of the joins on any input:

    * Two pages of a day can lead to one id (``/products/42`` and ``42``). They
      are counted apart and come out as two rows, which the key check refuses.
    * A NULL date matches nothing in a join, so rows without a date are also
      grouped by their source.
    """
    rows = reduce(
        DataFrame.unionByName,
        [view_measures(sessions), review_measures(reviews), recommendation_measures(recommendations)],
    )
    totals = rows.groupBy("date", "product_id", "undated").agg(
        *[F.sum(m).alias(m) for m in MEASURES]
    )
    return popularity_rows(totals, as_of)


def _measured(rows: DataFrame, source: int) -> DataFrame:
    return rows.filter("product_id IS NOT NULL").select(
        "date",
        "product_id",
        F.when(F.col("date").isNull(), F.lit(source)).alias("undated"),
        *[F.col(m) if m in rows.columns else F.lit(0).cast("bigint").alias(m) for m in MEASURES],
    )


def view_measures(sessions: DataFrame) -> DataFrame:
    """(date, product_id, undated, measures): a row a page view."""
    page = F.col("page")
    views = _viewed(sessions).select(
        "date",
        strip_prefix(page).alias("product_id"),
        page.rlike(PRODUCT_PREFIX).cast("bigint").alias("prefixed_views"),
        (~page.rlike(PRODUCT_PREFIX)).cast("bigint").alias("bare_views"),
    )
    return _measured(views, 0)


def review_measures(reviews: DataFrame) -> DataFrame:
    """The same, a row an approved review."""
    rated = _approved(reviews).select(
        "date",
        "product_id",
        F.lit(1).cast("bigint").alias("reviews"),
        F.col("rating").cast("bigint").alias("rating_sum"),
        F.col("rating").isNotNull().cast("bigint").alias("rated"),
    )
    return _measured(rated, 1)


def recommendation_measures(recommendations: DataFrame) -> DataFrame:
    """The same, a row a recommended product."""
    advised = _recommended(recommendations).select(
        "date", "product_id", F.lit(1).cast("bigint").alias("recommendations")
    )
    return _measured(advised, 2)


def popularity_rows(totals: DataFrame, as_of: datetime | None) -> DataFrame:
    """The mart from the totals of (date, product, undated)."""
    prefixed, bare = F.col("prefixed_views"), F.col("bare_views")
    counts = F.when((prefixed > 0) & (bare > 0), F.array(prefixed, bare)).otherwise(
        F.array(prefixed + bare)
    )
    rating = F.coalesce(
        mean_2dp(F.col("rating_sum"), F.col("rated")), F.lit(0).cast("decimal(3,2)")
    )
    return totals.withColumn("views", F.explode(counts)).select(
        "date",
        "product_id",
        as_int(F.col("views"), "total_views").alias("total_views"),
        as_int(F.col("reviews"), "total_reviews").alias("total_reviews"),
        as_numeric(rating, 3, "avg_rating").alias("avg_rating"),
        as_int(F.col("recommendations"), "times_recommended").alias("times_recommended"),
        instant(as_of).alias("updated_at"),
    )
