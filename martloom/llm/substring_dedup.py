"""Substring dedup by prefix-partitioned suffix trees over words.

Suffixes of the documents' word sequences are split into groups of bounded size by a prefix:
first by the words at their anchor (``anchors``), and where such a group exceeds
``GROUP_LIMIT`` segments, by the longest prefix that matters, the whole window. A group's
suffixes in sorted order are its subtree: suffixes below one node stand together. The topmost
nodes at a depth of ``WINDOW`` words or more are the repeats; a suffix under such a node is
removable when the node also holds a document of smaller id.

Defined cases: a null text has no words and loses none; a null doc_id is neither smaller nor
larger than another, so its document stays whole; rows repeated with id and text do not count
against each other and give one result each; a text shorter than a window stays whole; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.anchors import split_words
from martloom.llm.common import Scratch, table
from martloom.llm.segments import Segment, Unit, keyed, removed_runs, union_of

WINDOW = 50
PREFIX = 8  # words of the first prefix
GROUP_LIMIT = 8_000  # segments of which one subtree is built in memory

KEPT_ROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
     ("removed", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())]
)
KEPT_DDL = "doc_id long, n_words long, n_removed long, removed array<struct<first: long, end: long>>, kept string"


def deep_nodes(segments: list[Segment], unit: Unit) -> Iterator[list[tuple[int, int]]]:
    """Topmost nodes of ``unit.window`` words or more: the (segment, window) of the suffixes below each."""
    suffixes = []
    for i, segment in enumerate(segments):
        at = unit.bounds(segment.data)
        suffixes += [
            (segment.data[at[j] :], at[j + unit.window] - at[j], i, j) for j in range(segment.n)
        ]
    suffixes.sort()
    node: list[tuple[int, int]] = []
    label = None
    for text, depth, i, j in suffixes:
        if label is None or not text.startswith(label):
            if len(node) > 1:
                yield node
            node, label = [], text[:depth]
        node.append((i, j))
    if len(node) > 1:
        yield node


def joined_runs(places: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(segment, first window, windows) of neighbouring windows."""
    places.sort()
    begin = None
    for n, (i, j) in enumerate(places):
        begin = begin if begin is not None else j
        if n + 1 == len(places) or places[n + 1] != (i, j + 1):
            yield i, begin, j - begin + 1
            begin = None


def _settle(unit: Unit):
    def settle(segments: list[Segment]) -> Iterator[tuple[int, int, int]]:
        removable = []
        for node in deep_nodes(segments, unit):
            smallest = min(segments[i].doc for i, _ in node)
            removable += [(i, j) for i, j in node if segments[i].doc > smallest]
        return joined_runs(removable)

    return settle


def _keeper(window: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, text, runs, whole in zip(batch.column(0).to_pylist(), texts, batch.column(2), batch.column(3).to_pylist()):
                tokens = split_words(text or b"")
                spans = union_of(runs.as_py(), bool(whole), len(tokens), window)
                at, kept = 0, []
                for first, end in spans:
                    kept += tokens[at:first]
                    at = end
                kept += tokens[at:]
                removed = [{"first": a, "end": b} for a, b in spans]
                rows.append((doc, len(tokens), len(tokens) - len(kept), removed, b" ".join(kept).decode()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), KEPT_ROW)], schema=KEPT_ROW
            ) if rows else pa.RecordBatch.from_pylist([], KEPT_ROW)

    return keep


def dedup_substrings(docs: DataFrame, window: int = WINDOW, limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, n_words, n_removed, removed spans of words, kept text) of every document."""
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    unit = Unit(words=True, window=window, k=min(PREFIX, window), same_document=False)
    named = keyed(docs)
    runs = removed_runs(named, unit, _settle(unit), limit, scratch)
    joined = named.join(runs, ["doc_id", "tag"], "left").select("doc_id", "text", "runs", "whole")
    return joined.mapInArrow(_keeper(window), KEPT_DDL)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_substrings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: The windows, joined as word lists: what the subtrees must find.
ORACLE = {
    "op2_substring_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT r, doc_id, i, md5(list_aggregate(w[i:i + {WINDOW - 1}], 'string_agg', ' ')) AS h
      FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM d)),
f AS (SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM g) WHERE first < doc_id),
x AS (SELECT DISTINCT r, i + k AS i FROM f, range({WINDOW}) AS k(k)),
t AS (SELECT r, doc_id, len(w)::BIGINT AS n_words, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(v, ' ' ORDER BY i) AS s FROM t WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.r = t.r AND x.i = t.i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
}
