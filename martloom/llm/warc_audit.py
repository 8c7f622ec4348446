"""WARC fixity audit with Merkle trees.

Records of a WARC file are leaves, hashed over their bytes and their place. Leaves are
grouped by ordered offset ranges of ``SPAN`` bytes, ranges by ``FANOUT`` into nodes, up to
one root a file. Two replicas are compared root by root; only below mismatching nodes the
next level is read and compared, down to the records. Records of equal replicas are hashed
once and never compared.

The hashes are DataFrame functions, levels are tables and a descent is a join with the
mismatching nodes. A file is as hot as it is long: its leaves are spread over the tasks by
(file, range), and a node has at most ``FANOUT`` children.

Defined cases: a null file is a file of its own; a null payload is hashed as missing, apart
from an empty one; records equal in file and offset are one leaf whose digest covers all of
them in order of digest; a file missing from one replica differs at its root, and all its
records are reported; empty tables have no roots; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import Scratch, table

SPAN = 1 << 17  # bytes of a file that a leaf range covers
FANOUT = 16
FILE_BYTES = 1 << 22  # bytes after which ``warc_records`` begins another file
BLOCK = 512  # pages of which the offsets are summed in one task


def warc_records(pages: DataFrame) -> DataFrame:
    """Pages as WARC response records: (file, offset, length, page_id, record).

    Pages go to blocks by id, each block to files of about ``FILE_BYTES``; offsets are running
    sums inside a block, so no sum runs over the table.
    """
    html = F.coalesce("html", F.lit(""))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.0"),
        F.lit("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.coalesce("url", F.lit(""))),
        F.concat(F.lit("Content-Length: "), F.octet_length(html).cast("string")),
        F.lit(""),
        F.lit(""),
    )
    record = F.concat(head, html, F.lit("\r\n\r\n"))
    block = F.floor(F.coalesce("page_id", F.lit(0)) / BLOCK)
    made = pages.select("page_id", block.alias("block"), record.alias("record"))
    made = made.withColumn("length", F.octet_length("record").cast("long"))
    order = Window.partitionBy("block").orderBy("page_id", F.xxhash64("record"))
    before = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    made = made.withColumn("at", before).withColumn("part", F.floor(F.col("at") / FILE_BYTES))
    first = F.min("at").over(Window.partitionBy("block", "part"))
    name = F.format_string("crawl-%08d-%04d.warc", "block", "part")
    return made.select(name.alias("file"), (F.col("at") - first).alias("offset"), "length", "page_id", "record")


def leaves(records: DataFrame) -> DataFrame:
    """(file, node, offset, digest): a leaf a record, in its offset range."""
    place = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"))
    content = F.coalesce(F.sha2("record", 256), F.lit("missing"))
    digest = F.sha2(F.concat_ws("|", place, content), 256)
    leaf = records.select("file", "offset", F.floor(F.col("offset") / SPAN).alias("node"), digest.alias("digest"))
    return leaf.groupBy("file", "node", "offset").agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list("digest")), ""), 256).alias("digest")
    )


def _combine(children: DataFrame, node: Column, order: str) -> DataFrame:
    joined = F.transform(
        F.sort_array(F.collect_list(F.struct(order, "digest"))),
        lambda e: F.concat_ws("=", e[order].cast("string"), e["digest"]),
    )
    return children.groupBy("file", node.alias("node")).agg(F.sha2(F.array_join(joined, ","), 256).alias("digest"))


def tree(records: DataFrame, scratch: Scratch, name: str, height: int) -> list[DataFrame]:
    """Levels from the leaves (0) and their ranges (1) to the roots, written once each."""
    levels = [scratch.save(leaves(records), f"{name}-0")]
    levels.append(scratch.save(_combine(levels[0], F.col("node"), "offset"), f"{name}-1"))
    for level in range(2, height + 2):
        up = levels[-1].withColumnRenamed("node", "child")
        levels.append(scratch.save(_combine(up, F.floor(F.col("child") / FANOUT), "child"), f"{name}-{level}"))
    return levels


def _height(*replicas: DataFrame) -> int:
    """Levels above the ranges until every file has one node."""
    most = 0
    for records in replicas:
        most = max(most, records.agg(F.max(F.floor(F.col("offset") / SPAN))).first()[0] or 0)
    height = 0
    while most > 0:
        most //= FANOUT
        height += 1
    return height


def _differ(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose digests differ or that one side lacks, null-safe in the file."""
    left = a.select(*key, F.col("digest").alias("a"))
    right = b.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("digest").alias("b"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    both = left.join(right, on, "full").where(~F.col("a").eqNullSafe(F.col("b")))
    there = F.when(F.col("a").isNotNull(), F.struct(*key)).otherwise(
        F.struct(*[F.col(f"_{k}").alias(k) for k in key])
    )
    return both.select(there.alias("k"), "a", "b").select("k.*", "a", "b")


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """(file, offset, fault) of the records in which two replicas differ.

    Both are (file, offset, length, record); ``fault`` is corrupt, missing (from the replica)
    or added (to it).
    """
    scratch = Scratch(original.sparkSession, "warc-audit")
    height = _height(original, replica)
    ours = tree(original, scratch, "original", height)
    theirs = tree(replica, scratch, "replica", height)
    bad = scratch.save(_differ(ours[-1], theirs[-1], ["file", "node"]).select("file", "node"), "bad-top")
    for level in range(height, -1, -1):
        parent = F.floor(F.col("node") / FANOUT) if level else F.col("node")
        key = ["file", "node"] if level else ["file", "node", "offset"]
        wrong = bad.selectExpr("file AS bad_file", "node AS bad_node")
        within = F.col("file").eqNullSafe(F.col("bad_file")) & (parent == F.col("bad_node"))
        below = [side[level].join(wrong, within, "left_semi") for side in (ours, theirs)]
        bad = scratch.save(_differ(*below, key), f"bad-{level}")
    fault = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "added").otherwise("corrupt")
    return bad.select("file", "offset", fault.alias("fault"))


def damaged(records: DataFrame) -> DataFrame:
    """A replica with faults: derived from the records, to have something to find."""
    kind = F.pmod("page_id", F.lit(211))
    record = F.when(kind == 7, F.concat(F.lit("X"), F.substring("record", 2, 1 << 30))).otherwise(F.col("record"))
    offset = F.when(kind == 13, F.col("offset") + 1).otherwise(F.col("offset"))
    kept = records.where((kind != 101) | kind.isNull())
    return kept.select("file", offset.alias("offset"), "length", "page_id", record.alias("record"))


def op7_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of a damaged replica of all pages' records."""
    records = warc_records(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return audit(records, damaged(records))


ORACLE = {
    "op7_warc_audit": f"""
WITH r AS (SELECT page_id, page_id // {BLOCK} AS block, concat('WARC/1.0', e, 'WARC-Type: response', e,
                  'WARC-Record-ID: <urn:page:', page_id::VARCHAR, '>', e, 'WARC-Target-URI: ', coalesce(url, ''), e,
                  'Content-Length: ', octet_length(encode(coalesce(html, '')))::VARCHAR, e, e, coalesce(html, ''), e, e) AS record
           FROM (SELECT *, chr(13) || chr(10) AS e FROM pages)),
s AS (SELECT *, (coalesce(sum(octet_length(encode(record))) OVER (PARTITION BY block ORDER BY page_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS pos FROM r),
p AS (SELECT *, pos // {FILE_BYTES} AS part FROM s),
f AS (SELECT page_id, printf('crawl-%08d-%04d.warc', block, part) AS file, pos - min(pos) OVER (PARTITION BY block, part) AS "offset" FROM p)
SELECT file, "offset", CASE page_id % 211 WHEN 7 THEN 'corrupt' ELSE 'missing' END AS fault FROM f WHERE page_id % 211 IN (7, 13, 101)
UNION ALL SELECT file, "offset" + 1, 'added' FROM f WHERE page_id % 211 = 13
"""
}
