"""Substring dedup over words and over bytes, against dictionaries of all windows."""

from __future__ import annotations

import os
import random

import pyarrow as pa
import pytest

from martloom.llm import segments, suffix_array_dedup
from martloom.llm.segments import Segment
from martloom.llm.substring_dedup import dedup_substrings
from martloom.llm.suffix_array_dedup import dedup_bytes, nearest_smaller

SF_DIR = "/root/testdata/sf0.001"
HAVE = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")


def covered(places, size, window):
    hit = [False] * size
    for p in places:
        hit[p : p + window] = [True] * window
    return hit


def brute_words(rows, window):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for doc, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, w in split:
        found = [
            i for i in range(len(w) - window + 1)
            if doc is not None and first[tuple(w[i : i + window])] < doc
        ]
        hit = covered(found, len(w), window)
        out.append((doc, len(w), sum(hit), b" ".join(x for x, h in zip(w, hit) if not h).decode()))
    return sorted(out, key=str)


def brute_bytes(rows, window):
    first = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for doc, t in texts:
        for i in range(len(t) - window + 1):
            if doc is not None:
                key = t[i : i + window]
                first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for doc, t in texts:
        found = [
            i for i in range(len(t) - window + 1)
            if doc is not None and first[t[i : i + window]] < (doc, i)
        ]
        hit = covered(found, len(t), window)
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out.append((doc, len(t), sum(hit), spans, bytes(b for b, h in zip(t, hit) if not h)))
    return sorted(out, key=str)


def edge_rows():
    base = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(30))
    rows = [
        (1, base), (2, base), (2, base), (3, f"{other} {base}"), (4, f"x {base} y {base}"),
        (5, None), (6, ""), (7, "  \n\t"), (None, base), (8, "ab " * 300), (9, "ab " * 301),
        (10, "z" * 900), (11, "é" * 120 + base), (12, "\x1c\x00 ctl " * 40), (13, base[5:] + " " + base[:70]),
        (14, other), (15, "ab " * 50 + other),
    ]
    return rows + [(20 + i, f"t{i} {base} e{i} {other} t{i}") for i in range(30)]


def check_words(spark, rows, window, limit):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({})
    got = dedup_substrings(df.selectExpr("doc_id", "text", "1 AS tag", "'x' AS runs"), window, limit)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()]
    assert sorted(got, key=str) == brute_words(rows, window)


def check_bytes(spark, rows, window, limit):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_bytes(df.selectExpr("doc_id", "text", "1 AS tag", "'x' AS runs"), window, limit)
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in got.collect()]
    assert sorted(got, key=str) == brute_bytes(rows, window)


@pytest.mark.parametrize("window,limit", [(10, 8000), (10, 1), (3, 2), (25, 4)])
def test_words_with_edges(spark, window, limit):
    check_words(spark, edge_rows(), window, limit)


@pytest.mark.parametrize("window,limit", [(40, 4000), (40, 1), (24, 3)])
def test_bytes_with_edges(spark, window, limit):
    check_bytes(spark, edge_rows(), window, limit)


def sample(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


@HAVE
@pytest.mark.parametrize("limit", [8000, 1])
def test_words_of_the_sample(spark, limit):
    check_words(spark, sample(spark), 50, limit)


@HAVE
@pytest.mark.parametrize("limit", [4000, 1])
def test_bytes_of_the_sample(spark, limit):
    check_bytes(spark, sample(spark), 100, limit)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_substrings(empty).count() == 0 and dedup_bytes(empty).count() == 0


def test_nearest_smaller():
    assert nearest_smaller([3, 1, 2, 2, 0, 5]) == [-1, -1, 1, 1, -1, 4]


def test_only_suffixes_that_repeat_are_sorted(monkeypatch):
    rng = random.Random(4)
    shared = rng.randbytes(14)
    parts = [Segment(d, at, 15, rng.randbytes(5) + shared + rng.randbytes(5)) for d, at in [(9, 0), (-3, 7), (9, 40), (2, 1 << 31)]]
    parts += [Segment(2, 100, 11, b"ab" * 10), Segment(2, 100, 11, b"ab" * 10)]  # of two rows of one doc_id
    ranked, nearest = [], suffix_array_dedup.nearest_smaller
    monkeypatch.setattr(suffix_array_dedup, "nearest_smaller", lambda values: ranked.append(len(values)) or nearest(values))
    found = suffix_array_dedup.later_windows(parts, 10)
    places = [(s.data[j : j + 10], (s.doc, s.start + j), (i, j)) for i, s in enumerate(parts) for j in range(s.n)]
    least = {}
    for text, place, _ in places:
        least[text] = min(least.get(text, place), place)
    assert sorted(found) == sorted(at for text, place, at in places if place > least[text])
    assert ranked == [4 * 5 + 2 * 11]
    assert suffix_array_dedup.later_windows([Segment(1, 0, 11, bytes(range(20)))], 10) == [] and len(ranked) == 1


def test_runs_of_texts_in_order():
    run = pa.struct([("pack", pa.int64()), ("anchor", pa.int64())])
    kind, tag = segments.LATER << 60, 5 << 40
    rows = [[{"pack": 9}], [{"pack": 7 | 2 << 32 | tag | kind, "anchor": -4}, {"pack": 3 | 1 << 32 | tag, "anchor": 8}], [], [{"pack": 0, "anchor": 1}]]
    runs, ends = segments._in_order(pa.array(rows, pa.list_(run)).slice(1))
    assert runs == [(3 | 1 << 32, 8), (7 | 2 << 32, -4), (0, 1)] and ends == [0, 2, 2, 3]
