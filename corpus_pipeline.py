"""The corpus pipeline: stages over the documents table, each on all that its predecessor kept.

Every stage but the last returns the columns of ``documents``. Rejected documents, later
near-duplicates and contaminated documents go; secrets are masked in place, so that a document
is not lost for one; what is left is packed into sequences. Nulls, empty tables and repeated
rows are treated as the stages' operators define it; equal rows are near-duplicates too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import decontamination, jaccard_join, packing, quality_rules, secrets
from martloom.llm.common import Scratch, table, text_tag
from martloom.llm.segments import TAG_BITS

#: Near duplicates of the pipeline: shingles of five words, similarity 0.8 or more.
NEAR = jaccard_join.Similarity(words=5, num=80, den=100)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep, unchanged."""
    return quality_rules.measure(docs).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of least doc_id; those without an id stay."""
    joined = jaccard_join.join_similar(docs.select("doc_id", "text"), NEAR)
    chosen = joined.where("doc_id = component").selectExpr("doc_id AS _id", "tag AS _of")
    tag = text_tag(F.col("text")).bitwiseAND((1 << TAG_BITS) - 1).cast("int")
    named = docs.withColumn("_tag", tag)
    kept = named.join(chosen, F.expr("doc_id = _id AND _tag = _of")).dropDuplicates(["doc_id", "_tag"])
    return kept.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark passage."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    judged = decontamination.decontaminate(docs.select("doc_id", "text"), items)
    bad = judged.where("contaminated").selectExpr("doc_id AS _id", "tag AS _of")
    named = docs.withColumn("_tag", text_tag(F.col("text")))
    return named.join(bad, F.expr("doc_id <=> _id AND _tag = _of"), "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return secrets.redact(docs, secrets.learn(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: The network is trained and the packing searched for, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
