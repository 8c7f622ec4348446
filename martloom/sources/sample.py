"""The five raw tables derived from the sample star schema and event stream.

Every group that is collected into an array has a bound that holds at any scale;
all else is plain aggregation with a partial step.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.schemas import RawTable

# A session never spans two segments of this many consecutive event ids.
EVENTS_PER_SEGMENT = 4096
REVIEW_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def user_sessions(events: DataFrame) -> DataFrame:
    """One session per (user, half day, event segment).

    ``collect_set`` drops copies of an event, and a segment has at most
    EVENTS_PER_SEGMENT ids, so no array is longer than that however hot a user is.
    """
    number = F.get_json_object("props", "$.k")
    page = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("/products/"), number))
        .when(F.col("event_type") == "click", F.concat(F.lit("/click/"), number))
        .when(F.col("event_type") != "error", F.concat(F.lit("/"), F.col("event_type")))
    )
    action = F.when(F.col("event_type") != "signup", F.col("event_type"))
    grouped = (
        events.select(
            "user_id",
            F.to_date("ts").alias("day"),
            F.when(F.hour("ts") < 12, "a").otherwise("p").alias("half"),
            F.call_function("div", F.col("event_id"), F.lit(EVENTS_PER_SEGMENT)).alias("segment"),
            F.struct("ts", "event_id", page.alias("page"), action.alias("action")).alias("event"),
        )
        .groupBy("user_id", "day", "half", "segment")
        .agg(F.array_sort(F.collect_set("event")).alias("events"))
    )
    user = F.col("user_id").cast("string")
    day = F.regexp_replace(F.col("day").cast("string"), "-", "")
    first, last = F.element_at("events", 1), F.element_at("events", -1)
    return grouped.select(
        F.concat_ws("_", user, F.concat(day, "half"), F.col("segment").cast("string")).alias(
            "session_id"
        ),
        user.alias("user_id"),
        first["ts"].alias("start_time"),
        F.when(F.size("events") > 1, last["ts"]).alias("end_time"),
        F.array_compact(F.col("events.page")).alias("pages_visited"),
        F.when(F.col("user_id") % 3 == 0, "mobile")
        .when(F.col("user_id") % 3 == 1, "desktop")
        .alias("device"),
        F.array_compact(F.col("events.action")).alias("actions"),
    )


def event_logs(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").alias("timestamp"),
        "event_type",
        F.col("props").alias("details"),
    )


def _lines_per_order(lineitem: DataFrame, *aggregates) -> DataFrame:
    """One fixed-size row per order, so that a hot order is small before the join."""
    return lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(*aggregates)


def support_tickets(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One ticket per order; ``messages`` lists the months in which lines were shipped.

    The months travel as a 12-bit mask: constant size per group.
    """
    lines = _lines_per_order(
        lineitem,
        F.max("l_shipdate").alias("updated_at"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.month("l_shipdate"))).alias("months"),
    )
    months = F.filter(
        F.sequence(F.lit(1), F.lit(12)),
        lambda m: F.col("months").bitwiseAND(F.call_function("shiftleft", F.lit(1), m)) != 0,
    )
    status = F.create_map(*[F.lit(v) for v in ("F", "closed", "O", "open", "P", "pending")])
    return orders.join(lines, "o_orderkey", "left").select(
        F.col("o_orderkey").cast("string").alias("ticket_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.try_element_at(status, F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("issue_type"),
        F.when(F.col("months").isNotNull(), F.to_json(months)).alias("messages"),
        F.col("o_orderdate").alias("created_at"),
        "updated_at",
    )


def review_rows(lineitem: DataFrame) -> DataFrame:
    """Reviews before duplicates are removed; ``read_order`` gives their order."""
    flags = F.array_compact(
        F.array(
            F.when(F.col("l_discount") > 0.05, "high_discount"),
            F.when(F.col("l_tax") > 0.04, "high_tax"),
        )
    )
    status = F.create_map(*[F.lit(v) for v in ("A", "approved", "R", "rejected", "N", "pending")])
    day = F.make_dt_interval((F.col("l_orderkey") % 30).cast("int"))
    return lineitem.select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("review_id"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.concat(F.lit("review of "), F.col("l_partkey")).alias("review_text"),
        (F.col("l_quantity").cast("int") % 5 + 1).alias("rating"),
        F.try_element_at(status, F.col("l_returnflag")).alias("moderation_status"),
        flags.alias("flags"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + day).alias("submitted_at"),
        F.struct(*REVIEW_ORDER).alias("read_order"),
    )


def moderation_queue(lineitem: DataFrame) -> DataFrame:
    """The newest row of each review. Copies of a review are reduced to one before the shuffle."""
    newest = lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.max(F.struct(*REVIEW_ORDER, "l_discount", "l_tax", "l_returnflag")).alias("line")
    )
    return review_rows(newest.select("l_orderkey", "l_linenumber", "line.*")).drop("read_order")


def user_recommendations(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Per customer the lowest and highest part number of each return flag, NULLs kept.

    Six numbers per group, so the list is bounded and stays in a hash aggregate.
    """
    picks = [
        (f"{name}_{flag}", fn, flag)
        for flag in ("A", "N", "R")
        for name, fn in (("low", F.min), ("high", F.max))
    ]
    lines = _lines_per_order(
        lineitem,
        *[
            fn(F.when(F.col("l_returnflag") == flag, F.col("l_partkey"))).alias(name)
            for name, fn, flag in picks
        ],
    )
    per_user = (
        orders.select("o_orderkey", "o_custkey")
        .join(lines, "o_orderkey")
        .groupBy("o_custkey")
        .agg(*[fn(name).alias(name) for name, fn, _ in picks])
    )
    products = F.array_sort(F.array_distinct(F.array(*[name for name, _, _ in picks])))
    day = F.make_dt_interval((F.col("o_custkey") % 30).cast("int"))
    return per_user.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        products.cast("array<string>").alias("recommended_products"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + day).alias("last_updated"),
    )


def document_of(raw: RawTable, keep_nulls: bool = True, changes: Mapping[str, Column] | None = None) -> Column:
    """JSON text of a row, with ``changes`` in place of some of its columns.

    ``keep_nulls=False`` leaves NULL columns out. JSON columns are nested, not quoted.
    """
    changed = changes or {}
    values = [
        F.parse_json(c.name).alias(c.name) if c.kind.value == "json" else changed.get(c.name, F.col(c.name)).alias(c.name)
        for c in raw.columns
    ]
    options = {
        "ignoreNullFields": str(not keep_nulls).lower(),
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    }
    return F.to_json(F.struct(*values), options)


def as_documents(rows: DataFrame, raw: RawTable, keep_nulls: bool = True) -> DataFrame:
    """Rows of a raw table written back as ``(document, read_order)``; the key decides the order."""
    return rows.select(document_of(raw, keep_nulls).alias("document"), F.struct(raw.key).alias("read_order"))
