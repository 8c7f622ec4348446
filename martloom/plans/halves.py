"""Distinct counts of two halves, made apart and merged."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import distinct
from martloom.operators.moderation_stats import review_measures
from martloom.operators.support_efficiency import ticket_measures
from martloom.plans import stored
from martloom.sources import sample
from martloom.sources.files import Files

_WRITTEN: dict[tuple, DataFrame] = {}


def _drop(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        Files(spark).delete(path)


def merged_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(measure, date, name, n): distinct users and products per group of the two small marts.

    Rows are split by their key into two halves. The second half extends the dictionary of the
    first; each makes its bitmaps, and only these are merged. Tables go when the process ends.
    """
    key = (spark.sparkContext.applicationId, sf_dir, stored.state_of(sf_dir))
    if key in _WRITTEN:
        return _WRITTEN[key]
    root = f"{stored.shared_folder(spark).rstrip('/')}/distinct-{uuid.uuid4().hex}"
    atexit.register(_drop, spark, root)
    orders, lines = (sample.table(spark, sf_dir, n) for n in ("orders", "lineitem"))
    tickets, reviews = sample.support_tickets(orders, lines), sample.moderation_queue(lines)
    wanted = {  # by the first hex digit of the key's MD5
        "support users": (tickets, "ticket_id", ticket_measures, "issue_type", "user_id"),
        "review users": (reviews, "review_id", review_measures, "moderation_status", "user_id"),
        "review products": (reviews, "review_id", review_measures, "moderation_status", "product_id"),
    }
    counts = []
    for n, (measure, (rows, row_key, measures, group, value)) in enumerate(wanted.items()):
        dictionary, parts = spark.createDataFrame([], distinct.DICTIONARY), []
        for half, chosen in enumerate((F.md5(row_key) < "8", F.md5(row_key) >= "8")):
            mine = measures(rows.where(chosen)).select("date", group, value)
            dictionary = distinct.extend(dictionary, mine.select(value), f"{root}/{n}-{half}")
            path = f"{root}/{n}-{half}/bits"
            distinct.bitmaps(mine, ["date", group], F.col(value), dictionary).write.parquet(path)
            parts.append(spark.read.parquet(path))
        both = distinct.counted(distinct.merged(parts, ["date", group]), ["date", group])
        counts.append(both.select(F.lit(measure).alias("measure"), "date", F.col(group).alias("name"), "n"))
    _WRITTEN[key] = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return _WRITTEN[key]


QUERIES = {"merged_distinct": merged_distinct}
