"""The queries a driver can run by name, each over the whole sample tables.

Stamps are left out, arrays are joined to text, and every computed column has
the name its SQL counterpart in :mod:`martloom.plans.oracle` gives it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.timestamps import with_utc_times
from martloom.operators import quality
from martloom.operators.moderation_stats import moderation_stats
from martloom.operators.product_popularity import (
    product_popularity,
    product_recommendations,
    product_reviews,
    product_views,
)
from martloom.operators.support_efficiency import support_efficiency
from martloom.operators.upsert import upsert
from martloom.operators.user_activity import session_durations, user_activity
from martloom.plans import dumps, halves, stored
from martloom.schemas import (
    EVENT_LOGS,
    MODERATION_QUEUE,
    SUPPORT_TICKETS,
    USER_RECOMMENDATIONS,
    USER_SESSIONS,
    RawTable,
)
from martloom.sources import sample
from martloom.sources.documents import accepted, documents_from, parse, rejected

Query = Callable[[SparkSession, str], DataFrame]

# Rows before these moments are the stored table, the others the batch.
SESSION_CUT = "2024-01-16 00:00:00"
REVIEW_CUT = "1998-01-01 00:00:00"


def _joined(name: str) -> Column:
    return F.array_join(name, ",", "NULL").alias(name)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.table(spark, sf_dir, "events")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.table(spark, sf_dir, "lineitem")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.table(spark, sf_dir, "orders")


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.user_sessions(_events(spark, sf_dir))


def _tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.support_tickets(_orders(spark, sf_dir), _lines(spark, sf_dir))


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.moderation_queue(_lines(spark, sf_dir))


def _recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.user_recommendations(_orders(spark, sf_dir), _lines(spark, sf_dir))


def _through_documents(rows: DataFrame, table: RawTable, keep_nulls: bool = True) -> DataFrame:
    """Rows written as JSON documents and parsed back; all must be accepted and typed."""
    parsed = parse(sample.as_documents(rows, table, keep_nulls), table)
    loaded = quality.enforce(accepted(parsed, table), table)
    arrays = {c.name for c in table.columns if c.kind.value == "text array"}
    return loaded.select(*[_joined(c) if c in arrays else c for c in table.column_names])


# --- documents to raw rows ---------------------------------------------------


def raw_user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_documents(_sessions(spark, sf_dir), USER_SESSIONS)


def raw_event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_documents(sample.event_logs(_events(spark, sf_dir)), EVENT_LOGS)


def raw_support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_documents(_tickets(spark, sf_dir), SUPPORT_TICKETS, keep_nulls=False)


def raw_user_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_documents(_recommendations(spark, sf_dir), USER_RECOMMENDATIONS)


def raw_moderation_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_documents(_reviews(spark, sf_dir), MODERATION_QUEUE)


def _written(ts: str, pattern: str) -> Column:
    return F.date_format(ts, pattern)


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event time in one of thirteen spellings, eight of them valid."""
    seconds = "yyyy-MM-dd'T'HH:mm:ss"
    spellings = (
        _written("ts", seconds + ".SSSSSS'Z'"),
        _written("ts", seconds + ".SSSSSS'+03:00'"),
        _written("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS'-05:30'"),
        _written("ts", "yyyy-MM-dd"),
        _written("ts", "yyyy-MM-dd'x'HH:mm"),
        _written("ts", seconds + ".SSS"),
        _written("ts", seconds + "'+01:02:03'"),
        _written("ts", "yyyy/MM/dd HH:mm:ss"),
        _written("ts", seconds + "'+0300'"),
        _written("ts", "' 'yyyy-MM-dd'T'HH:mm:ss"),
        F.lit("bad"),
        F.lit(""),
        _written("ts", "yyyy-MM-dd'Z'"),
    )
    text = F.coalesce(*[F.when(F.col("event_id") % 13 == n, s) for n, s in enumerate(spellings)])
    written = _events(spark, sf_dir).select("event_id", text.alias("text"))
    return with_utc_times(written, {"parsed": "text"})


def _edge_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A session document per event; which keys are absent, null or broken depends on its id."""
    n = F.col("event_id")
    ident = F.concat(F.lit('"session_id":"e'), n, F.lit('"'))
    user = F.when(n % 11 == 0, "").otherwise(F.concat(F.lit(',"user_id":'), F.col("user_id")))
    start = F.concat(
        F.lit(',"start_time":"'),
        F.when(n % 13 == 0, "yesterday").otherwise(
            _written("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        ),
        F.lit('"'),
    )
    end = (
        F.when(n % 5 == 0, "")
        .when(n % 5 == 1, ',"end_time":null')
        .when(n % 5 == 2, ',"end_time":""')
        .when(n % 35 == 3, ',"end_time":"later"')
        .otherwise(
            F.concat(
                F.lit(',"end_time":"'), _written("ts", "yyyy-MM-dd'T'HH:mm:ss'+01:00'"), F.lit('"')
            )
        )
    )
    device = (
        F.when(n % 3 == 0, "")
        .when(n % 3 == 1, ',"device":null')
        .otherwise(F.concat(F.lit(',"device":"'), F.col("event_type"), F.lit('"')))
    )
    pages = (
        F.when(n % 4 == 0, "")
        .when(n % 4 == 1, ',"pages_visited":null')
        .when(n % 4 == 2, ',"pages_visited":[]')
        .otherwise(
            F.concat(F.lit(',"pages_visited":["/'), F.col("event_type"), F.lit('",null]'))
        )
    )
    text = F.concat(F.lit('{"_id":"x",'), ident, user, start, end, device, pages, F.lit("}"))
    text = F.when(n % 17 == 0, F.concat(text, F.lit(","))).otherwise(text)
    docs = _events(spark, sf_dir).select("event_id", text.alias("document"))
    return parse(documents_from(docs, "document", ["event_id"]), USER_SESSIONS)


def parse_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted(_edge_sessions(spark, sf_dir), USER_SESSIONS)
    return rows.select(
        "session_id",
        "user_id",
        "start_time",
        "end_time",
        _joined("pages_visited"),
        "device",
        _joined("actions"),
    )


def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rejected(_edge_sessions(spark, sf_dir), USER_SESSIONS)
    return rows.select("collection", "key", "reason")


# --- upsert ------------------------------------------------------------------


def parse_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings as fractions, text, wrong types and numbers out of range, by event id."""
    spellings = ("4.5", "2.4", "-2.5", '" 3 "', '"4.5"', "[1]", "2147483648", None, "null")
    rating = F.lit("")
    for n, text in enumerate(spellings):
        if text is not None:
            rating = F.when(F.col("event_id") % 9 == n, f',"rating":{text}').otherwise(rating)
    document = F.concat(F.lit('{"review_id":"'), F.col("event_id"), F.lit('"'), rating, F.lit("}"))
    written = _events(spark, sf_dir).select("event_id", document.alias("text"))
    parsed = parse(documents_from(written, "text", ["event_id"]), MODERATION_QUEUE)
    return parsed.select("read_order.event_id", "rating", "type_error")


def upsert_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as versions of one session per (user, event type): first start, last all else."""
    events = _events(spark, sf_dir)
    versions = events.select(
        F.concat_ws("_", "user_id", "event_type").alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("start_time"),
        F.when(F.col("event_id") % 3 != 0, F.col("ts")).alias("end_time"),
        F.col("props").alias("device"),
        F.col("event_id").alias("version"),
    )
    names = ["session_id", "user_id", "start_time", "end_time", "device"]
    cut = F.lit(SESSION_CUT).cast("timestamp_ntz")
    older = versions.filter(F.col("start_time") < cut)
    newer = versions.filter(F.col("start_time") >= cut)
    nothing = spark.createDataFrame([], versions.select(*names).schema)
    order = ["start_time", "version"]
    stored = upsert(nothing, older, "session_id", order, sticky=["start_time"])
    return upsert(stored, newer, "session_id", order, sticky=["start_time"])


def upsert_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older lines as the stored reviews, newer ones as the batch."""
    rows = sample.review_rows(_lines(spark, sf_dir))
    names = [c for c in rows.columns if c != "read_order"]
    cut = F.lit(REVIEW_CUT).cast("timestamp_ntz")
    is_new = F.col("read_order.l_shipdate") >= cut
    nothing = spark.createDataFrame([], rows.select(*names).schema)
    stored = upsert(nothing, rows.filter(~is_new), "review_id", ["read_order"])
    merged = upsert(stored, rows.filter(is_new), "review_id", ["read_order"])
    return merged.withColumn("flags", F.array_join("flags", ",", "NULL"))


# --- marts -------------------------------------------------------------------


def _activity(mart: DataFrame) -> DataFrame:
    return mart.drop("updated_at").withColumn(
        "devices_used", F.array_join("devices_used", ",", "NULL")
    )


def user_activity_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity(user_activity(_sessions(spark, sf_dir)))


def user_activity_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity(user_activity(_sessions(spark, sf_dir), counting="plain"))


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_durations(_sessions(spark, sf_dir))


def support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return support_efficiency(_tickets(spark, sf_dir)).drop("updated_at")


def moderation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moderation_stats(_reviews(spark, sf_dir)).drop("updated_at")


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_views(_sessions(spark, sf_dir))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_reviews(_reviews(spark, sf_dir))


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_recommendations(_recommendations(spark, sf_dir))


def popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_popularity(
        _sessions(spark, sf_dir), _reviews(spark, sf_dir), _recommendations(spark, sf_dir)
    ).drop("updated_at")


# --- checks ------------------------------------------------------------------


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations per check of two tables with repeated keys and spoilt values."""
    rows = sample.review_rows(_lines(spark, sf_dir)).withColumns(
        {
            "review_id": F.when(F.col("rating") != 5, F.col("review_id")),
            "moderation_status": F.when(
                F.size("flags") == 2, F.concat(F.col("moderation_status"), F.lit(" after appeal"))
            ).otherwise(F.col("moderation_status")),
        }
    )
    tickets = _tickets(spark, sf_dir).withColumns(
        {
            "messages": F.when(F.col("status") == "pending", "{}").otherwise(F.col("messages")),
            "user_id": F.when(F.col("issue_type") != "5-LOW", F.col("user_id")),
        }
    )
    found = quality.check(rows, MODERATION_QUEUE).unionByName(
        quality.check(tickets, SUPPORT_TICKETS)
    )
    return found.groupBy("table", "check").agg(F.count("*").alias("violations"))


# --- the whole job -----------------------------------------------------------


def refresh_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of all five collections through loads, checks and marts; rows per stored table."""
    return stored.refresh_counts(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "raw_user_sessions": raw_user_sessions,
    "raw_event_logs": raw_event_logs,
    "raw_support_tickets": raw_support_tickets,
    "raw_user_recommendations": raw_user_recommendations,
    "raw_moderation_queue": raw_moderation_queue,
    "parse_timestamps": parse_timestamps,
    "parse_defaults": parse_defaults,
    "parse_rejects": parse_rejects,
    "parse_ratings": parse_ratings,
    "upsert_sessions": upsert_sessions,
    "upsert_reviews": upsert_reviews,
    "user_activity": user_activity_product,
    "user_activity_plain": user_activity_plain,
    "session_durations": durations,
    "support_efficiency": support,
    "moderation_stats": moderation,
    "product_views": views,
    "product_reviews": reviews,
    "product_recommendations": recommendations,
    "product_popularity": popularity,
    "quality_report": quality_report,
    "refresh_report": refresh_report,
    **stored.QUERIES,
    **dumps.QUERIES,
    **halves.QUERIES,
}
