"""Repeats of ``window`` symbols between texts, found group by group.

1. Every document's anchors (see ``anchors``) go to a shuffle by anchor. A map task sends
   one row a distinct anchor of its batch; the others are known to repeat already.
2. Runs of windows whose anchor repeats are cut out of the texts as segments. Of equal
   segments in a batch only the earliest travels; the later ones are settled at once.
3. Segments of one anchor meet in a group, of which equal ones are settled while it is read,
   so that a group holds distinct segments. The caller's ``settle`` compares these by suffixes.
4. A group above ``limit`` distinct segments is split further: each of its windows becomes
   a row keyed by the whole window, and Spark aggregates those.

Nothing is sampled or capped: steps 1 to 4 find every repeat of ``window`` symbols or more.
Texts that are equal as a whole are settled beforehand, by aggregation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.anchors import anchors, byte_symbols, split_words, word_symbols
from martloom.llm.common import Scratch, text_tag

SINGLE, FIRST, LATER = 0, 1, 2
TAG_BITS = 20
FLUSH = 20_000


class Segment(NamedTuple):
    doc: int
    start: int  # first window's place in its document
    n: int  # windows
    data: bytes


@dataclass(frozen=True)
class Unit:
    """How a text becomes symbols, and when an earlier equal window counts."""

    words: bool
    window: int
    k: int
    same_document: bool  # whether an earlier place of the same document counts

    def symbols(self, text: bytes) -> np.ndarray:
        return word_symbols(split_words(text)) if self.words else byte_symbols(text)

    def cutter(self, text: bytes) -> Callable[[int, int], bytes]:
        """Bytes of the windows ``start`` to ``start + n - 1``; each word ends with a blank."""
        if not self.words:
            return lambda start, n: text[start : start + n - 1 + self.window]
        tokens = split_words(text)
        joined = b" ".join(tokens) + b" "
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
        bounds = np.concatenate(([0], ends)).tolist()
        return lambda start, n: joined[bounds[start] : bounds[start + n - 1 + self.window]]

    def bounds(self, data: bytes) -> list[int]:
        """Places of the symbols of a segment, and its end."""
        if not self.words:
            return list(range(len(data) + 1))
        return [0, *(np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1).tolist()]

    def later(self, place: tuple[int, int], first: tuple[int, int]) -> bool:
        """Whether a window at ``first`` (document, start) counts against one at ``place``."""
        return place > first if self.same_document else place[0] > first[0]


#: (index of the segment, first window, windows) of runs that occur earlier.
Settle = Callable[[list[Segment]], Iterable[tuple[int, int, int]]]

ANCHOR_ROW = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("pack", pa.int64())])
SEGMENT_ROW = pa.schema([*ANCHOR_ROW, ("data", pa.binary())])
RESULT_ROW = pa.schema([("doc_id", pa.int64()), ("pack", pa.int64()), ("window", pa.binary())])


def _pack(start, n, tag, kind=0):
    return start | (n << 32) | (tag << 40) | (kind << 60)


def _start_n(pack: int) -> tuple[int, int]:
    return pack & 0xFFFFFFFF, (pack >> 32) & 0xFF


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _sampler(unit: Unit):
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            docs = batch.column(0).to_pylist()
            tags = batch.column(1).to_pylist()
            for doc, tag, text in zip(docs, tags, _texts(batch, 2)):
                runs = anchors(unit.symbols(text), unit.window, unit.k, unit.same_document)
                if len(runs.n):
                    ids = np.full(len(runs.n), doc)
                    made.append((runs.anchor, ids, _pack(runs.first, runs.n, tag), runs.again))
            if not made:
                continue
            value, doc, pack, again = (np.concatenate(part) for part in zip(*made))
            order = np.argsort(value, kind="stable")
            ordered = value[order]
            same = np.concatenate(([False], ordered[1:] == ordered[:-1]))
            several = (np.append(same[1:], False) | again[order]) & ~same
            kind = np.empty(len(value), np.int64)
            kind[order] = np.where(same, LATER, np.where(several, FIRST, SINGLE))
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(doc), pa.array(pack | (kind << 60))], schema=ANCHOR_ROW)

    return sample


class _Rows:
    """Output rows gathered into batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows = schema, []

    def full(self) -> bool:
        return len(self.rows) >= FLUSH

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[] for _ in self.schema]
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema
        )


def _in_order(runs: pa.ListArray) -> tuple[list[tuple[int, int]], list[int]]:
    """(start and number of windows, anchor) of the runs, text by text in order of start, and where each text's begin."""
    ends = runs.offsets.to_numpy()
    held = dict(zip((f.name for f in runs.type.value_type), runs.flatten().flatten()))
    pack, anchor = held["pack"].to_numpy() & ((1 << 40) - 1), held["anchor"].to_numpy()
    text = np.repeat(np.arange(len(runs)), np.diff(ends))
    order = np.lexsort((anchor, pack >> 32, pack & 0xFFFFFFFF, text))
    return list(zip(pack[order].tolist(), anchor[order].tolist())), (ends - ends[0]).tolist()


def _cutter(unit: Unit):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(SEGMENT_ROW)
        for batch in batches:
            first: dict[tuple[bytes, int], tuple[int, int]] = {}
            docs = batch.column(0).to_pylist()
            tags = batch.column(1).to_pylist()
            texts = _texts(batch, 2)
            runs, ends = _in_order(batch.column(3))
            for i in sorted(range(len(docs)), key=docs.__getitem__):
                doc, tag, of = docs[i], tags[i] << 40, unit.cutter(texts[i])
                for pack, anchor in runs[ends[i] : ends[i + 1]]:
                    start, n = pack & 0xFFFFFFFF, pack >> 32
                    data, place = of(start, n), (doc, start)
                    earliest = first.setdefault((data, n), place)
                    settled = earliest is not place and unit.later(place, earliest)
                    out.rows.append((anchor, doc, pack | tag, None if settled else data))
                if out.full():
                    yield out.batch()
        yield out.batch()

    return cut


def _comparer(unit: Unit, settle: Settle, limit: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor, document and start."""
        out = _Rows(RESULT_ROW)
        group: dict[tuple[bytes, int], int] = {}
        segments: list[Segment] = []
        packs: list[list[int]] = []  # the first place of a segment, then others in its document
        current, split = None, False

        def windows(segment: Segment, pack: int) -> None:
            at = unit.bounds(segment.data)
            for j in range(segment.n):
                digest = hashlib.blake2b(segment.data[at[j] : at[j + unit.window]], digest_size=16).digest()
                out.rows.append((segment.doc, _pack(segment.start + j, 1, pack >> 40), digest))

        def finish() -> None:
            if not split and len({s.doc for s in segments}) >= (1 if unit.same_document else 2):
                for i, first, n in settle(segments):
                    for pack in packs[i]:
                        start = _start_n(pack)[0]
                        out.rows.append((segments[i].doc, _pack(start + first, n, pack >> 40), None))
            group.clear(), segments.clear(), packs.clear()

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in range(4)))
            for anchor, doc, pack, data in rows:
                if data is None:
                    out.rows.append((doc, pack, None))
                    continue
                if anchor != current:
                    finish()
                    current, split = anchor, False
                start, n = _start_n(pack)
                segment = Segment(doc, start, n, data)
                known = group.get((data, n))
                if known is not None and unit.later((doc, start), segments[known][:2]):
                    out.rows.append((doc, pack, None))
                elif split:
                    windows(segment, pack)
                elif known is not None:
                    packs[known].append(pack)
                else:
                    group[(data, n)] = len(segments)
                    segments.append(segment)
                    packs.append([pack])
                    if len(segments) > limit:
                        split = True
                        for s, places in zip(segments, packs):
                            for place in places:
                                windows(s._replace(start=_start_n(place)[0]), place)
                if out.full():
                    yield out.batch()
        finish()
        yield out.batch()

    return compare


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, text); the tag tells apart texts under one doc_id."""
    tag = text_tag(F.col("text")).bitwiseAND((1 << TAG_BITS) - 1)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tag.alias("tag"), "text")


def _tag_of(pack) -> F.Column:
    return F.shiftright(pack, 40).bitwiseAND((1 << TAG_BITS) - 1)


def removed_runs(docs: DataFrame, unit: Unit, settle: Settle, limit: int, scratch: Scratch) -> DataFrame:
    """(doc_id, tag, whole, runs) of ``keyed`` documents with windows that occur earlier.

    ``runs`` are sorted (first window, windows); ``whole`` marks copies of an earlier document.
    """
    usable = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    shas = usable.select("doc_id", "tag", F.sha2("text", 256).alias("sha"))
    earliest = shas.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = shas.join(earliest.where("last > first").select("sha", "first"), "sha").where("doc_id > first")
    copies = scratch.save(copies.select("doc_id", "tag").distinct(), "copies")

    sampled = usable.mapInArrow(_sampler(unit), _ddl(ANCHOR_ROW))
    kind = F.shiftright("pack", 60)
    # Later places of a batch only pass through: spread, whatever their anchor.
    salted = sampled.withColumn(
        "salt", F.when(kind == LATER, F.xxhash64("doc_id", "pack")).otherwise(F.lit(0).cast("long"))
    )
    same = F.count(F.lit(1)).over(Window.partitionBy("anchor", "salt"))
    repeated = salted.withColumn("n", same).where((F.col("n") > 1) | (kind > SINGLE))
    runs = repeated.withColumn("tag", _tag_of(F.col("pack"))).join(copies, ["doc_id", "tag"], "left_anti")
    # A list is bounded by its document's length.
    runs = runs.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("pack", "anchor")).alias("runs"))
    runs = scratch.save(runs, "runs")

    segments = usable.join(runs, ["doc_id", "tag"]).mapInArrow(_cutter(unit), _ddl(SEGMENT_ROW))
    met = segments.withColumn(
        "salt", F.when(F.col("data").isNull(), F.xxhash64("doc_id", "pack")).otherwise(F.lit(0).cast("long"))
    )
    met = met.repartition("anchor", "salt").sortWithinPartitions(
        "anchor", "doc_id", F.col("pack").bitwiseAND(0xFFFFFFFF)
    )
    compared = met.select("anchor", "doc_id", "pack", "data").mapInArrow(
        _comparer(unit, settle, limit), _ddl(RESULT_ROW)
    )
    compared = scratch.save(compared, "compared")

    place = F.struct("doc_id", F.col("pack").bitwiseAND(0xFFFFFFFF).alias("start"))
    split = compared.where("window IS NOT NULL").withColumn("place", place)
    earliest = split.groupBy("window").agg(F.min("place").alias("first"))
    later = F.col("place") > F.col("first") if unit.same_document else F.col("doc_id") > F.col("first.doc_id")
    split = split.join(earliest, "window").where(later).select("doc_id", "pack")

    found = compared.where("window IS NULL").select("doc_id", "pack").unionByName(split)
    run = F.struct(
        F.col("pack").bitwiseAND(0xFFFFFFFF).alias("first"),
        F.shiftright("pack", 32).bitwiseAND(0xFF).alias("n"),
    )
    found = found.select("doc_id", _tag_of(F.col("pack")).alias("tag"), F.lit(False).alias("whole"), run.alias("run"))
    whole = copies.select("doc_id", "tag", F.lit(True).alias("whole"), F.lit(None).cast(found.schema["run"].dataType).alias("run"))
    return found.unionByName(whole).groupBy("doc_id", "tag").agg(
        F.max("whole").alias("whole"), F.sort_array(F.collect_list("run")).alias("runs")
    )


def union_of(runs: list[dict] | None, whole: bool, size: int, window: int) -> list[tuple[int, int]]:
    """Disjoint, sorted, maximal (start, end) of the symbols that the windows of ``runs`` cover."""
    if size < window:
        return []
    if whole:
        return [(0, size)]
    spans: list[list[int]] = []
    for run in runs or []:
        start, end = run["first"], run["first"] + run["n"] - 1 + window
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [(a, b) for a, b in spans]
