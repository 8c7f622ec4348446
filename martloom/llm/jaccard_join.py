"""N-gram Jaccard join with signature trees.

Documents are sets of word shingles, as 64-bit hashes. Two link when their sets' Jaccard
similarity reaches ``num / den``; the result is a class per document, the smallest doc_id that
links reach.

1. Equal sets are one node from the start.
2. Hashes are ordered from rare to frequent: a table of ``BUCKETS`` counters holds how many
   documents have a hash of each bucket, counted over all documents. Any order gives the same
   links; this one keeps the hashes of widely shared passages out of the prefixes.
   Linked sets share one of their least ``n - ceil(t n) + 1`` hashes. Hashes that only one set
   holds are dropped by a shuffle of hashes; those with the same holders are one group, and
   a group whose holders all belong to another is left to that.
   A node's bitmap stands for its least ``COVER`` times as many hashes, its sketch. What two
   sets share lies in both sketches, or above the one that ends first and so in its rest: bits
   and rest together bound the overlap.
3. Each node joins the group of its least shared hash. There a signature tree, whose nodes
   hold the OR of their sets' bitmaps and the range of their sizes, is traversed against
   itself: a pair of tree nodes is left as soon as bitmaps or sizes rule out the overlap that
   a link needs. Surviving pairs are compared exactly, unless links join them already.
4. What is still apart though it shares a group is traversed across all groups, and the
   surviving pairs are compared, until none is left. A pair that step 3 compared, or that
   meets in the group of a lesser hash too, is left out. A text comes once to all its pairs of
   a group, as a row a pair with its texts would outgrow the documents. A quota of pairs for two components in
   a group makes a pass short while one link may join thousands; it grows from pass to pass,
   and the last pass is the one that it did not cut.

Groups above ``limit`` are dealt into blocks, and step 4 meets each block with each other,
so memory is bounded and no pair is lost. Links and components stay in Spark.

Defined cases: a null or empty text has an empty set and links with nothing; a text of fewer
words than a shingle is one shingle; equal rows link; a null doc_id keeps a null component and
gives no links; a doc_id with several texts links by each of them; other columns are not read. Distinct shingles
are told apart by their 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.anchors import gram_hashes, split_words, word_symbols
from martloom.llm.common import PACKED, Scratch, table
from martloom.llm.components import components
from martloom.llm.segments import FIRST, LATER, SINGLE, keyed

FANOUT = 8
COVER = 7  # prefixes that a sketch is long; whole sets at the similarities used here
LEAST_BITS, MOST_BITS = 64, 65_536
BITS_A_SHINGLE = 2  # at least; shingles that share a bit loosen the bound on the overlap
GROUP_LIMIT = 2_000  # sets of which one tree is built in memory
SHARE_PAIRS = 50_000  # pairs of one meeting that a task compares, about
QUOTA, QUOTA_GROWTH = 16, 256  # pairs allowed for two components in a group in the first pass, and their growth
COVER_STEPS = 2  # searches for groups that another covers; each finds some more
BUCKET_BITS = 22  # counters of hashes, whatever the size of the corpus: one byte each is broadcast
BUCKETS, COUNTER_PARTS = 1 << BUCKET_BITS, 16
COUNT_EVERY = 1_000_000  # hashes held by a task before they are counted
MARKED_BITS = 22  # bits that stand for the ids to be joined, whatever their number: half a MB is broadcast
DOCUMENT = 3  # kind of the rows that stand for a document


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words, and the similarity ``num / den`` that links."""

    words: int = 4
    num: int = 85
    den: int = 100

    def shingles(self, text: bytes) -> np.ndarray:
        symbols = word_symbols(split_words(text.lower()))
        if not len(symbols):
            return symbols
        return np.unique(gram_hashes(symbols, min(self.words, len(symbols))))

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def sketched(self, n: int) -> int:
        """How many of a set's least hashes its bitmap stands for."""
        return min(n, COVER * self.prefix(n))

    def needed(self, a: int, b: int) -> int:
        """Least overlap of linked sets of ``a`` and ``b`` shingles."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def sizes_fit(self, least: int, most: int, other_least: int, other_most: int) -> bool:
        return self.den * most >= self.num * other_least and self.den * other_most >= self.num * least

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)


# --- signature trees -----------------------------------------------------------


def width_of(n: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, BITS_A_SHINGLE << (n - 1).bit_length()))


def bitmap(shingles: np.ndarray, width: int) -> int:
    bits = np.zeros(width, np.uint8)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = 1
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def folded(bits: int, width: int, to: int) -> int:
    """The bitmap that a smaller width would have given."""
    while width > to:
        width //= 2
        bits = (bits & ((1 << width) - 1)) | (bits >> width)
    return bits


class Node:
    """OR of bitmaps, ranges of sizes and of sketches' ends, and what bounds an overlap.

    ``held`` is the most hashes of one sketch, ``excess`` the most of one that share a bit, and
    ``rest`` the most hashes of one set that are not in its sketch.
    """

    __slots__ = ("bits", "width", "least", "most", "held", "excess", "rest", "first_end", "last_end", "children", "leaf")

    def __init__(self, bits, width, least, most, held, excess, rest, first_end, last_end, children, leaf):
        self.bits, self.width, self.least, self.most = bits, width, least, most
        self.held, self.excess, self.rest = held, excess, rest
        self.first_end, self.last_end = first_end, last_end
        self.children, self.leaf = children, leaf


def leaf(bits: int, n: int, end: int, like: Similarity, index: int) -> Node:
    held = like.sketched(n)
    return Node(bits, width_of(held), n, n, held, held - bits.bit_count(), n - held, end, end, (), index)


def sketch(shingles: np.ndarray, like: Similarity) -> tuple[int, int]:
    """(bitmap, end) of a set: the end is its last hash, halved to fit a signed long."""
    head = shingles[: like.sketched(len(shingles))]
    return bitmap(head, width_of(len(head))), int(head[-1]) >> 1


def parent(children: list[Node]) -> Node:
    width = min(c.width for c in children)
    bits = 0
    for c in children:
        bits |= folded(c.bits, c.width, width)
    # Folding a bitmap of k bits may merge all but those of the smaller width.
    excess = max(
        c.excess if c.width == width else c.excess + c.bits.bit_count() - folded(c.bits, c.width, width).bit_count()
        if c.leaf is not None
        else c.held
        for c in children
    )
    return Node(
        bits,
        width,
        min(c.least for c in children),
        max(c.most for c in children),
        max(c.held for c in children),
        excess,
        max(c.rest for c in children),
        min(c.first_end for c in children),
        max(c.last_end for c in children),
        children,
        None,
    )


def tree(leaves: list[Node]) -> Node:
    """Leaves by size, so that size ranges are narrow."""
    level = sorted(leaves, key=lambda x: x.least)
    while len(level) > 1:
        level = [parent(level[i : i + FANOUT]) for i in range(0, len(level), FANOUT)]
    return level[0]


def may_link(a: Node, b: Node, like: Similarity) -> bool:
    """False if no set below ``a`` can link to one below ``b``."""
    if not like.sizes_fit(a.least, a.most, b.least, b.most):
        return False
    need = like.needed(a.least, b.least)
    # Ends are halved, so only a clear order tells which sketch ends first.
    if a.last_end < b.first_end:
        rest = a.rest
    elif b.last_end < a.first_end:
        rest = b.rest
    else:
        rest = max(a.rest, b.rest)
    if a.width == b.width:
        shared, spare_a, spare_b = (a.bits & b.bits).bit_count(), a.excess, b.excess
    else:
        width = min(a.width, b.width)
        small, large = (a, b) if a.width == width else (b, a)
        bits = folded(large.bits, large.width, width)
        spare = large.held if large.leaf is None else large.held - bits.bit_count()
        shared, spare_a, spare_b = (small.bits & bits).bit_count(), small.excess, spare
    return shared + min(spare_a, spare_b) + rest >= need


def pairs(a: Node, b: Node, like: Similarity) -> Iterator[tuple[int, int]]:
    """Leaf pairs below two trees, or below one and itself, that bitmaps and sizes let through."""
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        if a is b:
            if a.leaf is None:
                kids = a.children
                stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
            continue
        if not may_link(a, b, like):
            continue
        if a.leaf is not None and b.leaf is not None:
            yield a.leaf, b.leaf
        elif b.leaf is not None or (a.leaf is None and a.most - a.least >= b.most - b.least):
            stack += [(kid, b) for kid in a.children]
        else:
            stack += [(a, kid) for kid in b.children]


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.find(j)] = self.find(i)


# --- tasks -----------------------------------------------------------------------


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


COUNTER_ROW = pa.schema([("part", pa.int32()), ("counts", pa.binary())])
COUNTER_DDL = "part int, counts binary"


def bucket_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def ordered(shingles: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Hashes from rare to frequent, as longs: the level of the bucket, then 55 bits of the hash."""
    return np.sort((levels[bucket_of(shingles)].astype(np.int64) << 55) | (shingles >> np.uint64(9)).astype(np.int64))


def _counter(like: Similarity):
    """How many documents of a task have a hash of each bucket, in compressed parts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, held, size = np.zeros(BUCKETS, np.uint32), [], 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                held.append(bucket_of(like.shingles(text or b"")))
                size += len(held[-1])
                if size >= COUNT_EVERY:
                    totals += np.bincount(np.concatenate(held), minlength=BUCKETS).astype(np.uint32)
                    held, size = [], 0
        if held:
            totals += np.bincount(np.concatenate(held), minlength=BUCKETS).astype(np.uint32)
        for part, counts in enumerate(np.split(totals, COUNTER_PARTS)):
            if counts.any():
                yield _rows(COUNTER_ROW, [(part, zlib.compress(counts.tobytes(), 1))])

    return count


def _leveller(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the counters of all tasks, as levels: eight to each doubling."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(*(c.to_pylist() for c in batch.columns)):
            total = totals.setdefault(part, np.zeros(BUCKETS // COUNTER_PARTS, np.uint64))
            total += np.frombuffer(zlib.decompress(counts), np.uint32)
    for part, total in totals.items():
        yield _rows(COUNTER_ROW, [(part, np.minimum(255, 8 * np.log2(1.0 + total)).astype(np.uint8).tobytes())])


MARK_ROW = pa.schema(
    [("token", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("sig", pa.int64())]
)
MARK_DDL = "token long, doc_id long, tag int, kind int, n int, sig long"


def _marker(like: Similarity, shared):
    """A row a document, with its set's 128 bits, and one for each hash of its prefix."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            made, rows = [], []
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for doc, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                found = like.shingles(text or b"")
                high, low = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
                rows.append((int(high), doc, tag, DOCUMENT, len(found), int(low)))
                if len(found) and doc is not None:
                    tokens = ordered(found, levels)[: like.prefix(len(found))]
                    made.append((tokens, np.full(len(tokens), doc), np.full(len(tokens), tag, np.int32)))
            yield _rows(MARK_ROW, rows)
            if not made:
                continue
            token, doc, tag = (np.concatenate(part) for part in zip(*made))
            order = np.argsort(token, kind="stable")
            token, doc, tag = token[order], doc[order], tag[order]
            same = np.concatenate(([False], token[1:] == token[:-1]))
            several = np.append(same[1:], False) & ~same
            kind = np.where(same, LATER, np.where(several, FIRST, SINGLE)).astype(np.int32)
            none = pa.nulls(len(token))
            yield pa.RecordBatch.from_arrays(
                [pa.array(token), pa.array(doc), pa.array(tag), pa.array(kind), none.cast(pa.int32()), none.cast(pa.int64())],
                schema=MARK_ROW,
            )

    return mark


NODE_ROW = pa.schema(
    [("doc_id", pa.int64()), ("component", pa.int64()), ("n", pa.int32()), ("end", pa.int64()), ("bits", pa.binary())]
    + [("first", pa.int64()), ("part", pa.int64())]
)
NODE_DDL = "doc_id long, component long, n int, `end` long, bits binary, first long, part long"


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[dict]]:
    """Rows sorted by their first ``key`` columns, group by group."""
    current, held = None, []
    for batch in batches:
        names = batch.schema.names
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:key] != current:
                if held:
                    yield held
                current, held = row[:key], []
            held.append(dict(zip(names, row)))
    if held:
        yield held


def _clusterer(like: Similarity, limit: int):
    """Links inside the group of one hash, in blocks of ``limit``; rows come sorted by hash and block."""

    def cluster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for group in _groups(batches, 2):
            for at in range(0, len(group), limit):
                part = group[at : at + limit]
                sets = [like.shingles(r["text"].encode()) for r in part]
                sketches = [sketch(s, like) for s in sets]
                leaves = [leaf(bits, len(s), end, like, i) for i, (s, (bits, end)) in enumerate(zip(sets, sketches))]
                joined = Union(len(part))
                if len(part) > 1:
                    root = tree(leaves)
                    for i, j in pairs(root, root, like):
                        if joined.find(i) != joined.find(j) and like.linked(sets[i], sets[j]):
                            joined.join(i, j)
                least: dict[int, int] = {}
                for i, r in enumerate(part):
                    root_of = joined.find(i)
                    least[root_of] = min(least.get(root_of, r["doc_id"]), r["doc_id"])
                for i, r in enumerate(part):
                    bits = leaves[i].bits.to_bytes(leaves[i].width // 8, "little")
                    compared = r["block"] << 32 | at  # documents that this tree compared with each other
                    out.append((r["doc_id"], least[joined.find(i)], len(sets[i]), sketches[i][1], bits, r["first"], compared))
                if len(out) >= 5_000:
                    yield _rows(NODE_ROW, out)
                    out = []
        yield _rows(NODE_ROW, out)

    return cluster


PAIR_ROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cut", pa.bool_()), ("meeting", pa.int64())])
PAIR_DDL = "a long, b long, cut boolean, meeting long"


def _meets_elsewhere(a: dict, b: dict) -> bool:
    """True if the pair was compared when its first group was built, or shares a lesser open hash."""
    if a["first"] == b["first"] and a["part"] == b["part"]:
        return True
    return any(a[x] is not None and a[x] == b[x] for x in ("near", "wide"))


def _traverser(like: Similarity, quota: int):
    """Pairs between components in a group, or between two blocks of it, at most ``quota`` for two components."""

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for group in _groups(batches, 3):
            leaves = [leaf(int.from_bytes(r["bits"], "little"), r["n"], r["end"], like, i) for i, r in enumerate(group)]
            left, right, meeting = group[0]["i"], group[0]["j"], group[0]["meeting"]
            if left == right:
                found = pairs(root := tree(leaves), root, like)
            else:
                sides = [[x for x, r in zip(leaves, group) if r["block"] == side] for side in (left, right)]
                found = pairs(tree(sides[0]), tree(sides[1]), like) if all(sides) else ()
            seen: dict[tuple[int, int], int] = {}
            for i, j in found:
                a, b = group[i], group[j]
                if a["component"] == b["component"] or _meets_elsewhere(a, b):
                    continue
                key = tuple(sorted((a["component"], b["component"])))
                seen[key] = seen.get(key, 0) + 1
                if seen[key] <= quota:
                    out.append((min(a["doc_id"], b["doc_id"]), max(a["doc_id"], b["doc_id"]), False, meeting))
                elif seen[key] == quota + 1:
                    out.append((None, None, True, None))
            if len(out) >= 20_000:
                yield _rows(PAIR_ROW, out)
                out = []
        yield _rows(PAIR_ROW, out)

    return traverse


def _comparer(like: Similarity):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (meeting, share, a, b, text): the texts of a share, whose b is null, before its pairs.

        Pairs that links of the share join already are left out.
        """
        current, held, place, joined = None, [], {}, Union(0)
        for batch in batches:
            rows = []
            for meeting, share, a, b, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (meeting, share) != current:
                    current, held, place, joined = (meeting, share), [], {}, Union(0)
                if b is None:
                    place[a] = len(held)
                    joined.up.append(len(held))
                    held.append(like.shingles(text.encode()))
                    continue
                i, j = place[a], place[b]
                if joined.find(i) != joined.find(j) and like.linked(held[i], held[j]):
                    joined.join(i, j)
                    rows.append((a, b))
            yield _rows(schema, rows)

    return compare


# --- the join ----------------------------------------------------------------------


def _levels(named: DataFrame, like: Similarity) -> bytes:
    """One byte a bucket, greater where more documents have its hashes. The size is fixed."""
    counted = named.select("text").mapInArrow(_counter(like), COUNTER_DDL).repartition(COUNTER_PARTS, "part")
    parts = {r.part: bytes(r.counts) for r in counted.mapInArrow(_leveller, COUNTER_DDL).collect()}
    return b"".join(parts.get(part, bytes(BUCKETS // COUNTER_PARTS)) for part in range(COUNTER_PARTS))


def _marks(named: DataFrame, like: Similarity) -> DataFrame:
    """Document rows, and those of hashes that may have several holders."""
    levels = named.sparkSession.sparkContext.broadcast(_levels(named, like))
    marked = named.mapInArrow(_marker(like, levels), MARK_DDL)
    passing = F.col("kind") >= LATER
    salt = F.when(passing, F.xxhash64("doc_id", "token")).otherwise(F.lit(0).cast("long"))
    held = F.count(F.lit(1)).over(Window.partitionBy("token", "salt"))
    return marked.withColumn("salt", salt).withColumn("held", held).where((F.col("held") > 1) | (F.col("kind") > SINGLE)).drop("salt", "held")


def _shared(tokens: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """(token, doc_id) of hashes with two nodes or more; hashes with the same holders once."""
    firsts = members.where("doc_id = class").select("doc_id", "tag").distinct()
    held = scratch.save(tokens.join(firsts, ["doc_id", "tag"], "left_semi").select("token", "doc_id").distinct(), "held")
    mark = F.xxhash64("doc_id")
    holders = held.groupBy("token").agg(
        F.count("*").alias("c"), F.sum(mark.cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64(mark)).alias("x")
    )
    holders = holders.where("c > 1").groupBy("c", "s", "x").agg(F.min("token").alias("token"))
    chosen = scratch.save(holders.select("token", "c"), "chosen")
    shared = scratch.save(held.join(chosen, "token"), "shared")
    scratch.drop("held"), scratch.drop("chosen")
    for step in range(COVER_STEPS):
        kept = scratch.save(_uncovered(shared), f"shared-{step}")
        scratch.drop(f"shared-{step - 1}" if step else "shared")
        shared = kept
    return shared


def _with_lesser(shared: DataFrame) -> DataFrame:
    """Beside each hash of a holder, two lesser ones of it: the next below, and the widest held."""
    lesser = Window.partitionBy("doc_id").orderBy("token").rowsBetween(Window.unboundedPreceding, -1)
    rows = shared.withColumn("near", F.max("token").over(lesser))
    return rows.withColumn("wide", F.max(F.struct("c", "token")).over(lesser)["token"])


def _uncovered(shared: DataFrame) -> DataFrame:
    """``shared`` without hashes whose holders all hold one and the same lesser hash.

    The pairs of such a group meet in the lesser hash's group too. As prefixes are closed
    downwards, that is so for nearly all hashes of a passage but its least. Each holder names
    two lesser hashes: the next below, and the one that most sets hold.
    """
    named = _with_lesser(shared).groupBy("token", "c").agg(
        *(f(x).alias(f"{f.__name__}_{x}") for x in ("near", "wide") for f in (F.count, F.min, F.max))
    )
    one = [f"coalesce(count_{x} = c AND min_{x} = max_{x}, false)" for x in ("near", "wide")]
    return shared.join(named.where(f"NOT ({one[0]} OR {one[1]})").select("token"), "token")


def _unfinished(shared: DataFrame, nodes: DataFrame, limit: int) -> DataFrame:
    """Rows of groups that hold several components, dealt to the meetings of their blocks."""
    rows = shared.join(nodes.select("doc_id", "component"), "doc_id")
    apart = rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    apart = apart.where("lo < hi").select("token")
    rows = rows.join(apart, "token").drop("component").join(nodes, "doc_id")
    blocks = F.ceil(F.col("c") / limit)
    block = F.pmod(F.xxhash64("doc_id"), blocks)
    rows = rows.withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    rows = rows.select("token", "doc_id", "component", "n", "end", "bits", "block", "first", "part", "near", "wide", other)
    rows = rows.select(
        "token",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "doc_id", "component", "n", "end", "bits", "block", "first", "part", "near", "wide",
    )
    return rows.withColumn("meeting", F.xxhash64("token", "i", "j"))


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` whose doc_id may be in the one column of ``ids``; the join that tells comes next.

    Texts that no row of ``ids`` asks for are then not shuffled. The ids set bits of a table of
    fixed size, so more of them let more texts pass and broadcast no more.
    """
    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(1 << MARKED_BITS))

    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    words = ids.select(place(ids.columns[0]).alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("mask"))
    found = rows.withColumn("place", place("doc_id")).withColumn("word", F.shiftright("place", 6)).join(F.broadcast(words), "word")
    return found.where(F.call_function("bit_get", "mask", (F.col("place") % 64).cast("int")) == 1).select(*rows.columns)


def _verified(found: DataFrame, texts: DataFrame, like: Similarity) -> DataFrame:
    """Links among pairs (a, b, meeting); a large meeting is dealt to several tasks."""
    size = found.groupBy("meeting").agg(F.ceil(F.count("*") / SHARE_PAIRS).alias("shares"))
    dealt = found.join(size, "meeting").select("meeting", F.pmod(F.xxhash64("a"), "shares").alias("share"), "a", "b")
    asked = dealt.select("meeting", "share", "a").union(dealt.select("meeting", "share", "b")).distinct()
    wanted = _marked(texts, found.select("a").union(found.select("b")))
    asked = asked.join(wanted.select(F.col("doc_id").alias("a"), "text"), "a")
    asked = asked.select("meeting", "share", "a", F.lit(None).cast("long").alias("b"), "text")
    rows = asked.unionByName(dealt.withColumn("text", F.lit(None).cast("string")))
    rows = rows.repartition("meeting", "share").sortWithinPartitions("meeting", "share", F.col("b").asc_nulls_first(), "a")
    return rows.mapInArrow(_comparer(like), "a long, b long")


def join_similar(docs: DataFrame, like: Similarity = Similarity(), limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, tag, n_shingles, component) of every distinct (doc_id, text)."""
    named = keyed(docs).withColumn("tag", F.col("tag").cast("int"))
    return _joined(named, like, limit, Scratch(docs.sparkSession, "jaccard-join"))


def _apart(named: DataFrame, members: DataFrame, like: Similarity, limit: int, scratch: Scratch) -> DataFrame:
    """The join where ids have several texts: further texts get ids of their own, above all
    others, and what their links reach is united with what the first text's links do."""
    first = members.groupBy("doc_id").agg(F.min("tag").alias("first"))
    above = members.agg(F.max("doc_id").alias("top"))
    more = members.join(first, "doc_id").where("tag > first").select("doc_id", "tag").distinct()
    more = more.withColumn("nth", F.monotonically_increasing_id() + 1).crossJoin(above)
    more = scratch.save(more.selectExpr("doc_id AS of_id", "tag AS of_tag", "top + nth AS own"), "more")
    renamed = named.join(more, F.expr("doc_id = of_id AND tag = of_tag"), "left")
    renamed = renamed.select(F.coalesce("own", "doc_id").alias("doc_id"), "tag", "text")
    found = scratch.save(_joined(renamed, like, limit, Scratch(named.sparkSession, "jaccard-apart")), "apart")
    label = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component").alias("component"))
    ends = more.join(label.selectExpr("doc_id AS own", "component AS a"), "own")
    ends = ends.join(label.selectExpr("doc_id AS of_id", "component AS b"), "of_id").select("a", "b")
    united = components(ends, Scratch(named.sparkSession, "jaccard-united"))
    united = united.selectExpr("node AS component", "component AS joined")
    found = found.join(united, "component", "left").join(more, F.col("doc_id") == F.col("own"), "left")
    return found.select(
        F.coalesce("of_id", "doc_id").alias("doc_id"), "tag", "n_shingles", F.coalesce("joined", "component").alias("component")
    )


def _joined(named: DataFrame, like: Similarity, limit: int, scratch: Scratch) -> DataFrame:
    marks = scratch.save(_marks(named, like), "marks")
    every = marks.where(F.col("kind") == DOCUMENT)
    classes = every.where("n > 0 AND doc_id IS NOT NULL").groupBy("token", "sig", "n").agg(F.min("doc_id").alias("class"))
    members = scratch.save(
        every.join(classes, ["token", "sig", "n"], "left").select("doc_id", "tag", "n", "class").distinct(), "members"
    )
    several = members.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("tag").alias("lo"), F.max("tag").alias("hi"))
    if not several.where("lo < hi").isEmpty():
        scratch.drop("marks")
        return _apart(named, members.where("doc_id IS NOT NULL"), like, limit, scratch)
    shared = _shared(marks.where(F.col("kind") < DOCUMENT), members, scratch)
    scratch.drop("marks")

    least = shared.groupBy("doc_id").agg(F.min("token").alias("first"))
    firsts = members.where("doc_id = class").select("doc_id", "tag").distinct()
    # Each id has one text here, so its rows are equal.
    # A hot hash is spread over tasks; what its blocks leave apart meets in the passes below.
    # Blocks are dealt before the texts come, so that a text is shuffled to its id and to its block.
    size = shared.select("token", "c").distinct().selectExpr("token AS first", "c")
    block = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("c") / limit))
    wanted = firsts.join(least, "doc_id").join(size, "first").select("doc_id", "first", block.alias("block"))
    wanted = scratch.save(wanted, "wanted")
    texts = _marked(named.drop("tag"), wanted.select("doc_id")).join(wanted, "doc_id").dropDuplicates(["doc_id"])
    texts = scratch.save(texts.select("doc_id", "first", "block", "text"), "texts", PACKED)
    scratch.drop("wanted")
    dealt = texts.select("first", "block", "doc_id", "text").repartition("first", "block")
    nodes = dealt.sortWithinPartitions("first", "block", "doc_id").mapInArrow(_clusterer(like, limit), NODE_DDL)
    nodes = scratch.save(nodes, "nodes-0")

    # A group in one block, and the first of all its holders, is done with.
    done = texts.groupBy("first").agg(F.count("*").alias("met")).join(size, "first").where(f"met = c AND c <= {limit}")
    shared = scratch.save(_with_lesser(shared.join(done.selectExpr("first AS token"), "token", "left_anti")), "open")

    tried, quota, step = None, QUOTA, 0
    while True:
        step += 1
        rows = _unfinished(shared, nodes, limit).repartition("token", "i", "j")
        rows = rows.sortWithinPartitions("token", "i", "j", "doc_id").select("token", "i", "j", "doc_id", "component", "n", "end", "bits", "block", "first", "part", "near", "wide", "meeting")
        found = rows.mapInArrow(_traverser(like, quota), PAIR_DDL)
        found = scratch.save(found.groupBy("a", "b", "cut").agg(F.min("meeting").alias("meeting")), f"pairs-{step}")
        cut = not found.where("cut").isEmpty()
        fresh = found.where("NOT cut").select("a", "b", "meeting")
        if tried is not None:
            fresh = fresh.join(tried, ["a", "b"], "left_anti")
        tried = found.where("NOT cut").select("a", "b") if tried is None else tried.unionByName(fresh.select("a", "b"))
        fresh = scratch.save(fresh, f"fresh-{step}")
        links = scratch.save(_verified(fresh, texts, like), f"links-{step}")
        if not links.isEmpty():
            of = nodes.select("doc_id", "component")
            ends = links.join(of.selectExpr("doc_id AS a", "component AS x"), "a").join(of.selectExpr("doc_id AS b", "component AS y"), "b")
            merged = components(ends.selectExpr("x AS a", "y AS b"), Scratch(named.sparkSession, "jaccard-links"))
            merged = merged.selectExpr("node AS component", "component AS joined")
            nodes = nodes.join(merged, "component", "left").select(
                "doc_id", F.coalesce("joined", "component").alias("component"), "n", "end", "bits", "first", "part"
            )
            nodes = scratch.save(nodes, f"nodes-{step}")
        if not cut:
            break
        quota *= QUOTA_GROWTH
    joined = members.join(nodes.selectExpr("doc_id AS class", "component"), "class", "left")
    return joined.select(
        "doc_id", "tag", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class", "doc_id")).alias("component")
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_similar(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return joined.select("doc_id", "n_shingles", F.col("component").alias("component_id"))
