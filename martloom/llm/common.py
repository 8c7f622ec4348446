"""What the operators of this package share: column helpers and tables written between steps."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters between words.
WHITE = r"[\x20\x09-\x0D]+"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PACKED = "zstd"  # for tables of texts: a third smaller than the default
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column, between: str = WHITE) -> Column:
    """Words of a text, those of a null text none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def text_tag(text: Column) -> Column:
    """Tells apart rows of one doc_id; repeated rows share it, and so their result."""
    return F.xxhash64(text)


class Scratch:
    """Tables written between steps, below the folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``. Only in one process, as in tests, it
    may be unset, and a temporary one is made; on a cluster executors would not share that. A written table cuts the lineage: a
    lost executor costs a task's work and not the steps before it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="run-")
        self.root = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        writer = df.write.mode("overwrite")
        if compression:
            writer = writer.option("compression", compression)
        # The written table replaces the shuffles behind it, so their files can go at once.
        before = self.spark.conf.get(CLEAN_UP)
        self.spark.conf.set(CLEAN_UP, "true")
        try:
            writer.parquet(path)
        finally:
            self.spark.conf.set(CLEAN_UP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Give back the disk of a table that no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
