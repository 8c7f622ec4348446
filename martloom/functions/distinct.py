"""Exact distinct counts that can be merged.

Values get numbers from a dictionary, and the values of a group become bitmaps over the
numbers, a row a group and bucket of 32,768 numbers. Bitmaps of two halves, made apart, are merged
by OR, so a distinct count over both needs neither half's rows. A bitmap has 4 KB however few
values it holds: for coarse groups with many values. What has to be taken back again needs
counts instead (:mod:`martloom.operators.mart_state`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

DICTIONARY = T.StructType().add("value", "string").add("number", "long")


def extend(dictionary: DataFrame, values: DataFrame, path: str) -> DataFrame:
    """``dictionary`` (value, number) with the non-null values of a one-column frame that it lacks.

    Numbers count from 1; new ones follow the known ones without gaps, so bitmaps are full. They are written
    to ``path``, which fixes them. Numbering takes no global sort: each task counts its own
    rows, and a row a task tells where its numbers begin.
    """
    spark = values.sparkSession
    new = values.toDF("value").where("value IS NOT NULL").distinct().join(dictionary.select("value"), "value", "left_anti")
    new.withColumn("at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{path}/values")
    placed = spark.read.schema("value string, at long").parquet(f"{path}/values").withColumn("task", F.shiftright("at", 33))
    counts = placed.groupBy("task").agg(F.count("*").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    starts = counts.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    last = dictionary.agg(F.coalesce(F.max("number"), F.lit(0)).alias("known"))
    within = F.col("at").bitwiseAND((1 << 33) - 1)
    numbered = placed.join(starts, "task").crossJoin(last).select("value", (F.col("known") + F.col("start") + within + 1).alias("number"))
    numbered.write.mode("overwrite").parquet(f"{path}/numbers")
    return dictionary.unionByName(spark.read.schema(DICTIONARY).parquet(f"{path}/numbers"))


def bitmaps(rows: DataFrame, groups: Sequence[str], value: Column, dictionary: DataFrame) -> DataFrame:
    """(groups, bucket, bits) of the non-null values of each group; all are in the dictionary."""
    numbered = rows.select(*groups, value.alias("value")).where("value IS NOT NULL").join(dictionary, "value")
    return numbered.groupBy(*groups, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def merged(parts: Sequence[DataFrame], groups: Sequence[str]) -> DataFrame:
    """Bitmaps of the union of the parts' values."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(maps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups, n): distinct values of each group."""
    return maps.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias("n"))
