"""Suffix-array dedup by longest-previous-factor arrays over UTF-8 bytes.

In each group of segments that share an anchor (``anchors``) the suffixes are sorted, those that
agree in ``WINDOW`` bytes by their place in the corpus. For such a suffix, the nearest one before
it in that order which starts earlier in the corpus (smaller doc_id, or same document and smaller
start) is its longest earlier match as far as that matters; where it reaches ``WINDOW`` bytes, the
window is a later copy and goes. The first copy has no earlier neighbour and stays.

Defined cases: a null text has no bytes; a null doc_id is neither smaller nor larger than
another, so its document stays whole; rows repeated with id and text do not count against
each other and give one result each, but repeats inside a text count; a text shorter than a
window stays whole; other columns are not read. Kept bytes may end inside a character, so they
are binary.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain, repeat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import Scratch, table
from martloom.llm.segments import Segment, Unit, keyed, removed_runs, union_of
from martloom.llm.substring_dedup import joined_runs

WINDOW = 100
GRAM = 20  # bytes of an anchor
GROUP_LIMIT = 4_000  # distinct segments of which one suffix array is built in memory

KEPT_ROW = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
     ("removed", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
)
KEPT_DDL = "doc_id long, n_bytes long, n_removed long, removed array<struct<first: long, end: long>>, kept binary"


def nearest_smaller(values: list) -> list[int]:
    """For each place the nearest earlier place of a smaller value, or -1."""
    found, stack = [], []
    for i, value in enumerate(values):
        while stack and values[stack[-1]] >= value:
            stack.pop()
        found.append(stack[-1] if stack else -1)
        stack.append(i)
    return found


def later_windows(segments: list[Segment], window: int) -> list[tuple[int, int]]:
    """(segment, window) of the suffixes whose longest previous factor has ``window`` bytes or more."""
    texts = [s.data[j : j + window] for s in segments for j in range(s.n)]
    if len(set(texts)) == len(texts):
        return []
    seen = Counter(texts)
    rank = {doc: n for n, doc in enumerate(sorted({s.doc for s in segments}))}
    begins = [(rank[s.doc] << 32) + s.start for s in segments]
    places = list(chain.from_iterable(range(at, at + s.n) for at, s in zip(begins, segments)))
    # A suffix whose first ``window`` bytes stand nowhere else has a shorter factor: it is not sorted.
    suffixes = [k for k, text in enumerate(texts) if seen[text] > 1]
    suffixes.sort(key=places.__getitem__)
    suffixes.sort(key=texts.__getitem__)
    # Suffixes that agree in ``window`` bytes stand together in the order of their places, so the one that
    # starts earlier than another of them is before it.
    previous = nearest_smaller([places[k] for k in suffixes])
    ordered = [texts[k] for k in suffixes]
    owner = list(chain.from_iterable(repeat(i, s.n) for i, s in enumerate(segments)))
    first = list(accumulate((s.n for s in segments), initial=0))
    return [
        (owner[k], k - first[owner[k]])
        for k, text, p in zip(suffixes, ordered, previous)
        if p >= 0 and ordered[p] == text
    ]


def _settle(window: int):
    def settle(segments: list[Segment]) -> Iterator[tuple[int, int, int]]:
        return joined_runs(later_windows(segments, window))

    return settle


def _keeper(window: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, text, runs, whole in zip(batch.column(0).to_pylist(), texts, batch.column(2), batch.column(3).to_pylist()):
                text = text or b""
                spans = union_of(runs.as_py(), bool(whole), len(text), window)
                ends = [0, *(end for _, end in spans)]
                starts = [*(first for first, _ in spans), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends, starts))
                removed = [{"first": a, "end": b} for a, b in spans]
                rows.append((doc, len(text), len(text) - len(kept), removed, kept))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), KEPT_ROW)], schema=KEPT_ROW
            ) if rows else pa.RecordBatch.from_pylist([], KEPT_ROW)

    return keep


def dedup_bytes(docs: DataFrame, window: int = WINDOW, limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, removed spans of bytes, kept bytes) of every document."""
    scratch = Scratch(docs.sparkSession, "suffix-array-dedup")
    unit = Unit(words=False, window=window, k=min(GRAM, window), same_document=True)
    named = keyed(docs)
    runs = removed_runs(named, unit, _settle(window), limit, scratch)
    joined = named.join(runs, ["doc_id", "tag"], "left").select("doc_id", "text", "runs", "whole")
    return joined.mapInArrow(_keeper(window), KEPT_DDL)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_bytes(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
