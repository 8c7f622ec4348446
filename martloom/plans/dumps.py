"""Queries over a dump of reviews in extended JSON, written from the derived rows.

Ids are ``$oid`` values, ratings ``$numberInt``. Reviews whose key has an MD5 that begins with ``f``
carry a native date, which is not a text and is rejected. Small ranges make several tasks a file;
of a large dump they grow, so that its tasks stay below ``MOST_SPLITS`` up to 64 MB a range.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.plans import stored
from martloom.schemas import MODERATION_QUEUE
from martloom.sources import dump, sample
from martloom.sources.documents import accepted, parse, rejected
from martloom.sources.files import Files
from martloom.sources.warehouse import CLEAN_UP, JOINED_BYTES, READ_BYTES, SMALL_JOINED

SPLIT_BYTES = 1 << 20
MOST_SPLITS = 128
_WRITTEN: dict[tuple, str] = {}


def _drop(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        Files(spark).delete(path)


def _dump(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the dump; one for a session and state of the tables, gone when the process ends."""
    key = (spark.sparkContext.applicationId, sf_dir, stored.state_of(sf_dir))
    if key not in _WRITTEN:
        path = f"{stored.shared_folder(spark).rstrip('/')}/dump-{uuid.uuid4().hex}"
        atexit.register(_drop, spark, path)
        lines_of = sample.table(spark, sf_dir, "lineitem")
        reviews = sample.moderation_queue(lines_of)
        digest = F.md5("review_id")
        typed = reviews.select(
            F.struct(F.substring(digest, 1, 24).alias("$oid")).alias("_id"),
            *[F.col(c) for c in MODERATION_QUEUE.column_names if c not in ("rating", "submitted_at")],
            F.struct(F.col("rating").cast("string").alias("$numberInt")).alias("rating"),
            F.date_format("submitted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
        )
        native = F.substring("_id.$oid", 1, 1) == "f"
        others = [F.col(c) for c in typed.columns if c != "at"]

        def line(submitted: Column) -> Column:
            return F.to_json(F.struct(*others, submitted.alias("submitted_at")), {"ignoreNullFields": "false"})

        # A review without an id is in neither part.
        lines = typed.where(native.isNotNull()).select(F.when(native, line(F.struct(F.col("at").alias("$date")))).otherwise(line(F.col("at"))))
        shuffles = max(int(spark.conf.get(stored.SHUFFLES)), lines_of.count() // stored.SOURCE_ROWS + 1)
        sized = {stored.SHUFFLES: str(shuffles), READ_BYTES: stored.SMALL_READS, JOINED_BYTES: SMALL_JOINED, CLEAN_UP: "true"}
        with stored.settings(spark, sized):
            lines.write.text(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def split_bytes(size: int) -> int:
    """Bytes of a range of a dump of this size."""
    return min(max(SPLIT_BYTES, size // MOST_SPLITS), dump.SPLIT_BYTES)


def _read(spark: SparkSession, sf_dir: str, since: str | None = None) -> DataFrame:
    path = _dump(spark, sf_dir)
    return dump.read_dump(spark, path, since, split_bytes(Files(spark).size(path)))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(_read(spark, sf_dir), MODERATION_QUEUE)


def dump_moderation_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted reviews of the dump."""
    rows = accepted(_parsed(spark, sf_dir), MODERATION_QUEUE).drop("read_order", "type_error")
    return rows.withColumn("flags", F.array_join("flags", ",", "NULL"))


def dump_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected reviews of the dump, with the document as it was read."""
    return rejected(_parsed(spark, sf_dir), MODERATION_QUEUE)


def dump_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the upper half, by a filter that the source applies."""
    return parse(_read(spark, sf_dir, since="8"), MODERATION_QUEUE).select("review_id")


QUERIES = {
    "dump_moderation_queue": dump_moderation_queue,
    "dump_rejects": dump_rejects,
    "dump_since": dump_since,
}
