"""Mergeable distinct counts against plain ones."""

from __future__ import annotations

import random
from datetime import date

from pyspark.sql import functions as F

from martloom.functions import distinct


def test_halves_merge_exactly(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *(f"v{i}" for i in range(200))])) for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, v string")
    dictionary, parts = spark.createDataFrame([], distinct.DICTIONARY), []
    for n in range(3):
        mine = spark.createDataFrame(rows[300 * n : 300 * n + 300], "g string, v string")
        dictionary = distinct.extend(dictionary, mine.select("v"), str(tmp_path / str(n)))
        parts.append(distinct.bitmaps(mine, ["g"], F.col("v"), dictionary))
    found = {r["g"]: r["n"] for r in distinct.counted(distinct.merged(parts, ["g"]), ["g"]).collect()}
    assert found == {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
    numbers = sorted(r["number"] for r in dictionary.collect())
    assert numbers == list(range(1, 1 + len({v for _, v in rows} - {None})))


def test_many_values_take_several_buckets(spark, tmp_path):
    df = spark.range(100_000).selectExpr("date'2024-01-01' AS d", "cast(id % 70000 AS string) AS v")
    dictionary = distinct.extend(spark.createDataFrame([], distinct.DICTIONARY), df.select("v"), str(tmp_path))
    maps = distinct.bitmaps(df, ["d"], F.col("v"), dictionary)
    assert maps.count() == 3
    assert [tuple(r) for r in distinct.counted(maps, ["d"]).collect()] == [(date(2024, 1, 1), 70_000)]


def test_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "g string, v string")
    dictionary = distinct.extend(spark.createDataFrame([], distinct.DICTIONARY), empty.select("v"), str(tmp_path))
    assert dictionary.count() == 0
    assert distinct.counted(distinct.bitmaps(empty, ["g"], F.col("v"), dictionary), ["g"]).count() == 0
