"""Merkle dataset manifest by time-forward processing.

Every row is a leaf. The leaves of a source, by doc_id, are combined three by three to a
subroot; the subroots, by source, to the root. Trees are processed in the order of node labels
(last leaf below the node, level): children always come before their parent. A node sends its
digest to its parent's label through a priority queue and the parent finds all its children at
the head of the queue. A sweep in the reversed order sends each child the path above it, which
for a leaf is its proof.

The queue is external: trees are cut into blocks of ``FANOUT ** HEIGHT`` consecutive nodes, and
messages between blocks travel in an exchange that Spark sorts by label. Inside a block
the labels keep at most two messages a level waiting, so a heap holds them. Rounds of blocks
follow until every tree has one node; 10^10 leaves take three. A source with a third of all
rows is as many blocks as it needs, spread over the tasks. Only the rows' digests travel; a
text is read once.

Defined cases: a null column counts as ``-``; a null doc_id comes first and is never tampered
with; a null source is a source of its own, before all others; rows equal in doc_id are ordered
by leaf, and equal rows are leaves of their own; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import Scratch, table

FANOUT = 3
HEIGHT = 8  # levels of a block
BLOCK = FANOUT**HEIGHT
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FLUSH = 5_000

Label = tuple[int, int]  # last leaf below the node, level


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# --- one block ------------------------------------------------------------------------------


def height_of(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n = -(-n // FANOUT)
        levels += 1
    return levels


def _parent(label: Label, size: int) -> Label:
    last, level = label
    width = FANOUT ** (level + 1)
    return min((last // width + 1) * width, size) - 1, level + 1


def forward(digests: Iterable[str], size: int, levels: int) -> Iterator[tuple[Label, list[tuple[int, str]], str]]:
    """Inner nodes in label order: (label, children as (last leaf, digest), digest)."""
    queue: list[tuple[int, int, int, str]] = []  # label of the receiver, sender's last leaf, digest

    def send(label: Label, digest: str) -> None:
        if label[1] < levels:
            heapq.heappush(queue, (*_parent(label, size), label[0], digest))

    for leaf, digest in enumerate(digests):
        send((leaf, 0), digest)
        while queue and queue[0][0] <= leaf:
            label = queue[0][:2]
            children = []
            while queue and queue[0][:2] == label:
                children.append(heapq.heappop(queue)[2:])
            combined = hashed("".join(d for _, d in children))
            yield label, children, combined
            send(label, combined)


def backward(digests: list[str], levels: int, path: str) -> Iterator[tuple[int, str]]:
    """(leaf, path) of a block's leaves, last leaf first; ``path`` is that of the block's root.

    A path holds the levels from a node to the root, each as ``left,right;``: the digests of the
    run's others before and after the node.
    """
    nodes = {label: children for label, children, _ in forward(digests, len(digests), levels)}
    queue = [(1 - len(digests), -levels, path)]  # labels negated: the greatest comes first
    while queue:
        last, level, above = heapq.heappop(queue)
        if level == 0:
            yield -last, above
            continue
        children = nodes[-last, -level]
        for n, (below, _) in enumerate(children):
            left = "".join(d for _, d in children[:n])
            right = "".join(d for _, d in children[n + 1 :])
            heapq.heappush(queue, (-below, level + 1, f"{left},{right};{above}"))


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and its path lead to."""
    for level in path.split(";")[:-1]:
        left, right = level.split(",")
        leaf = hashed(left + leaf + right)
    return leaf


# --- all blocks -----------------------------------------------------------------------------


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (tree, block) after the other; a block has a bounded number of rows."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["tree"], row["block"]) != key:
                if rows:
                    yield rows
                key, rows = (row["tree"], row["block"]), []
            rows.append(row)
    if rows:
        yield rows


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    made: list[dict] = []
    for row in rows:
        made.append(row)
        if len(made) >= FLUSH:
            yield pa.RecordBatch.from_pylist(made, schema=schema)
            made = []
    yield pa.RecordBatch.from_pylist(made, schema=schema)


NODE = "tree string, pos long, n long, digest string"
_NODE = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
SENT = "tree string, pos long, path string, digest string, subroot string, root string"
_SENT = pa.schema([("tree", pa.string()), ("pos", pa.int64()), *((n, pa.string()) for n in ("path", "digest", "subroot", "root"))])
PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_PROOF = pa.schema(
    [("doc_id", pa.int64())]
    + [(n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    + [("verified", pa.bool_())]
)


def _roots_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def roots():
        for rows in _by_block(batches):
            n, digests = rows[0]["n"], [r["digest"] for r in rows]
            digest = digests[0]  # of a lone node
            for _, _, digest in forward(digests, len(digests), min(HEIGHT, height_of(n))):
                pass
            yield {"tree": rows[0]["tree"], "pos": rows[0]["block"], "n": -(-n // BLOCK), "digest": digest}

    return _batches(roots(), _NODE)


def _paths_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict, str]]:
    """(message to the block, node, path of the node); a message sorts before the nodes."""
    for message, *rows in _by_block(batches):
        levels = min(HEIGHT, height_of(rows[0]["n"]))
        for at, path in backward([r["digest"] for r in rows], levels, message["path"]):
            yield message, rows[at], path


def _send_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sent():
        for message, node, path in _paths_in_blocks(batches):
            yield {**{k: message[k] for k in ("subroot", "root")}, "tree": node["tree"], "pos": node["pos"], "path": path, "digest": node["digest"]}

    return _batches(sent(), _SENT)


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def proofs():
        for message, node, path in _paths_in_blocks(batches):
            folded = fold(node["tampered"] or node["digest"], path)
            yield {
                "doc_id": node["doc_id"],
                "leaf": node["digest"],
                "subroot": message["subroot"],
                "root": message["root"],
                "proof_sha256": hashed(path.replace(",", "").replace(";", "")),
                "folded_root": folded,
                "verified": folded == message["root"],
            }

    return _batches(proofs(), _PROOF)


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """Rows of a block in one task, in label order."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def placed(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with their place ``pos`` in their tree and its size ``n``; no tree is in one task.

    Rows are sorted over all tasks; the places follow from counts per (task, tree), of
    which there are fewer than trees and tasks together.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = scratch.save(ranged.withColumn("at", F.monotonically_increasing_id()), f"{name}-sorted")
    ranged = ranged.withColumn("task", F.shiftright("at", 33))
    counts = ranged.groupBy("task", "tree").agg(F.min("at").alias("start"), F.count("*").alias("here"))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "task",
        "tree",
        (F.coalesce(F.sum("here").over(earlier), F.lit(0)) - F.col("start")).alias("shift"),
        F.sum("here").over(whole).alias("n"),
    )
    found = ranged.join(counts, ["task", "tree"]).withColumn("pos", F.col("at") + F.col("shift"))
    return scratch.save(found.drop("at", "task", "shift"), name)


def climb(nodes: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """Nodes of each round, from the given ones to one a tree."""
    rounds, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = rounds[-1].select("tree", "pos", "n", "digest", F.expr(f"pos div {BLOCK} AS block"))
        above = _in_blocks(below).mapInArrow(_roots_of_blocks, NODE)
        rounds.append(scratch.save(above, f"{name}-{len(rounds)}"))
        most = -(-most // BLOCK)
    return rounds


def descend(rounds: list[DataFrame], message: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Messages to the nodes of the lowest round but one; ``message`` goes to the top ones."""
    for n in range(len(rounds) - 2, 0, -1):
        message = scratch.save(_delivered(rounds[n], message).mapInArrow(_send_down, SENT), f"{name}-{n}")
    return message


def _delivered(nodes: DataFrame, message: DataFrame) -> DataFrame:
    """Nodes and the messages to their blocks, which come first in a block."""
    nodes = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
    sent = message.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "path", "subroot", "root")
    return _in_blocks(nodes.unionByName(sent, allowMissingColumns=True))


# --- leaves and the query -------------------------------------------------------------------


def _part(column: Column) -> Column:
    text = column.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(text.isNull(), "-").otherwise(sized)


def leaf_digest(text: Column) -> Column:
    """Digest of a row of documents whose text is ``text``."""
    parts = [_part(text if c == "text" else F.col(c)) for c in LEAF_COLUMNS]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, tampered, row): trees are sources, in bytewise order, null first."""
    text = F.col("text")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    torn = chosen & F.contains(text, F.lit("\n"))
    return docs.select(
        F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), "source")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(text).alias("digest"),
        F.when(torn, leaf_digest(F.translate(text, "\n", ""))).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and what a tampered copy of it folds to."""
    scratch = Scratch(docs.sparkSession, "merkle-manifest")
    rows = scratch.save(leaves(docs), "leaves")
    sources = climb(placed(rows, ["doc_id", "digest", "row"], scratch, "placed"), scratch, "source")
    top = sources[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    whole = climb(placed(top, ["of"], scratch, "placed-sources"), scratch, "whole")

    # The reversed sweep: from the root to the sources, and from these to the leaves.
    root = whole[-1].where("pos = 0").select("tree", "pos", F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    if len(whole) > 1:
        sent = _delivered(whole[0].select("tree", "pos", "n", "digest"), descend(whole, root, scratch, "to-sources"))
        sent = scratch.save(sent.mapInArrow(_send_down, SENT), "to-sources-0").drop("subroot")
        sent = sent.join(whole[0].select("pos", "of"), "pos").withColumnRenamed("digest", "subroot")
    else:  # one source or none: its subroot is the root
        sent = root.drop("subroot").join(whole[0].select("pos", "of", F.col("digest").alias("subroot")), "pos")
    sent = sent.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", "subroot", "root")
    if len(sources) > 1:
        sent = descend(sources, sent, scratch, "to-leaves")
    lowest = sources[0].select("tree", "pos", "n", "digest", "doc_id", "tampered")
    return _delivered(lowest, sent).mapInArrow(_prove, PROOF)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest and proofs of all documents."""
    return manifest(table(spark, sf_dir, "documents").select(*LEAF_COLUMNS))


def _sized(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_sized(text if c == "text" else c) for c in LEAF_COLUMNS) + ")"


#: CRC-32 of ASCII text ``s`` in DuckDB: the table of its 256 remainders from its rule, one look-up a byte.
CRC_TABLE_SQL = """crc_table AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256))::BIGINT AS i)))"""


def crc_sql(byte_list: str) -> str:
    """Unsigned CRC-32 of a list of byte values, with the table ``t`` in scope."""
    folded = f"list_reduce(list_prepend(4294967295, {byte_list}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))"
    return f"xor({folded}, 4294967295)"


_RUNS = """SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 3, n"""

ORACLE = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE {CRC_TABLE_SQL},
rows AS (
  SELECT *, {_leaf_sql("text")} AS digest,
         CASE WHEN {crc_sql("[ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]")} % 2 = 0
              THEN {_leaf_sql("replace(text, chr(10), '')")} END AS tampered
  FROM documents, crc_table),
leaf AS (
  SELECT doc_id, digest, coalesce(tampered, digest) AS tampered,
         coalesce('1' || source, '0') AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n
  FROM rows),
low(tree, level, idx, digest, n) AS (
  SELECT tree, 0, idx, digest, n FROM leaf UNION ALL {_RUNS.format(name="low")}),
top(tree, level, idx, digest, n) AS (
  SELECT '', 0, row_number() OVER (ORDER BY tree) - 1, digest, count(*) OVER () FROM low WHERE n = 1
  UNION ALL {_RUNS.format(name="top")}),
nodes AS (
  SELECT * FROM low UNION ALL SELECT * FROM top),
beside AS (
  SELECT a.tree, a.level, a.idx, a.n,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
  GROUP BY ALL),
up(id, tree, level, idx, digest, proof) AS (
  SELECT row_number() OVER (ORDER BY tree, idx), tree, 0, idx, tampered, '' FROM leaf
  UNION ALL
  SELECT id, u.tree, u.level + 1, u.idx // 3, sha256(l || u.digest || r), proof || l || r
  FROM up u JOIN beside s ON s.tree = u.tree AND s.level = u.level AND s.idx = u.idx WHERE s.n > 1),
half AS (
  SELECT id, tree, digest, proof FROM up QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1),
sources AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx FROM low WHERE n = 1),
over(id, level, idx, digest, proof) AS (
  SELECT id, 0, s.idx, h.digest, h.proof FROM half h JOIN sources s USING (tree)
  UNION ALL
  SELECT id, u.level + 1, u.idx // 3, sha256(l || u.digest || r), proof || l || r
  FROM over u JOIN beside s ON s.tree = '' AND s.level = u.level AND s.idx = u.idx WHERE s.n > 1),
done AS (
  SELECT id, digest AS folded_root, proof FROM over QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1)
SELECT doc_id, f.digest AS leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM (SELECT *, row_number() OVER (ORDER BY tree, idx) AS id FROM leaf) f
JOIN done USING (id) JOIN sources s ON s.tree = f.tree, (SELECT digest AS root FROM top WHERE n = 1) whole
"""
}
