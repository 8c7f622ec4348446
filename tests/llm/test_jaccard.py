"""Jaccard join against all pairs of plain sets."""

from __future__ import annotations

import os
import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from martloom.llm import jaccard_join
from martloom.llm.jaccard_join import (
    Similarity,
    bitmap,
    folded,
    join_similar,
    leaf,
    may_link,
    pairs,
    sketch,
    tree,
)

SF_DIR = "/root/testdata/sf0.01"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, like):
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, []).append(shingles(text, like.words))
    up = {d: d for d in sets}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        for x in sets[a]:
            for y in sets[b]:
                if x and y and like.den * len(x & y) >= like.num * len(x | y):
                    ra, rb = sorted((find(a), find(b)))
                    up[rb] = ra
    out = set()
    for doc, text in rows:
        out.add((doc, len(shingles(text, like.words)), find(doc) if doc is not None else None))
    return out


def check(spark, rows, like, limit):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS tag", "2 AS n", "'x' AS component")
    got = [(r.doc_id, r.n_shingles, r.component) for r in join_similar(df, like, limit).collect()]
    assert set(got) == brute(rows, like) and len(got) == len(set(rows))


def families(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One"), (5, "one"), (6, "one two three"), (7, "ONE two  three"), (None, "one"), (8, "É x y z"), (9, "é x y z")]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    doc = 20
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(2, 9)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((doc, " ".join(text)))
            doc += 1
    for _ in range(25):  # unrelated but for a passage
        own = [rng.choice(vocabulary) for _ in range(rng.randint(5, 40))]
        rows.append((doc, " ".join(own[:3] + passage + own[3:])))
        doc += 1
    rows += [(doc, rows[15][1]), (doc + 1, rows[15][1]), (doc + 1, rows[15][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("like,limit", [(Similarity(), 2000), (Similarity(), 3), (Similarity(5, 80, 100), 4), (Similarity(2, 50, 100), 5)])
def test_families(spark, like, limit):
    check(spark, families(), like, limit)


def test_several_texts_of_one_id(spark):
    """Each of them links; which one comes first makes no difference."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a), (5, b), (1, a + " x"), (2, b + " y"), (5, b), (8, a), (9, "c d e f g"), (9, None), (9, "c d e f"), (7, "c d e f g")]
    check(spark, sorted(set(rows), key=str), Similarity(), 2000)
    check(spark, sorted(set(rows), key=str, reverse=True), Similarity(), 2)
    many = families() + [(doc, text) for (doc, _), (_, text) in zip(families(3)[:30], families(4)[30:60])]
    check(spark, [r for r in dict.fromkeys(many)], Similarity(), 3)


def test_a_shingle_in_every_document(spark):
    rng = random.Random(8)
    rows = [(n, "the same four words " + " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 60)))) for n in range(150)]
    rows += [(200 + n, text + " z") for n, text in rows[:40]] + [(400, "long " + " ".join(f"v{i}" for i in range(60_000)))]
    check(spark, rows, Similarity(), 20)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")
def test_sample(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    check(spark, rows, Similarity(), 2000)


def test_empty_table(spark):
    assert join_similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_trees_lose_no_link():
    rng = np.random.default_rng(5)
    like = Similarity(4, 60, 100)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64)
        for _ in range(4):
            keep = base[rng.random(len(base)) < 0.9]
            more = rng.integers(0, 2**63, rng.integers(0, 1 + len(base) // 4), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([keep, more, base[:1]])))
    made = [sketch(s, like) for s in sets]
    leaves = [leaf(bits, len(s), end, like, i) for i, (s, (bits, end)) in enumerate(zip(sets, made))]
    root = tree(leaves)
    found = {tuple(sorted(p)) for p in pairs(root, root, like)}
    linked = {(i, j) for i, j in combinations(range(len(sets)), 2) if like.linked(sets[i], sets[j])}
    assert linked and linked <= found and len(found) < len(sets) * (len(sets) - 1) / 2 / 4
    assert all(may_link(leaves[i], leaves[j], like) for i, j in linked)
    assert folded(bitmap(sets[0], 512), 512, 64) == bitmap(sets[0], 64)


@pytest.mark.parametrize("share,texts", [(50_000, 30), (40, None)])
def test_a_text_comes_once_to_its_pairs(spark, monkeypatch, share, texts):
    """Not once for each pair; dealing a meeting to tasks loses no pair."""
    rng, like, seen = random.Random(5), Similarity(2, 50, 100), spark.sparkContext.accumulator(0)
    bases = [[f"{b}{i}" for i in range(30)] for b in "xyz"]
    rows = [(i, " ".join(w if rng.random() > 0.1 else "other" for w in bases[i % 3])) for i in range(30)]
    made = jaccard_join._comparer

    def counting(like):
        compare = made(like)

        def count(batches):
            def look():
                for batch in batches:
                    seen.add(sum(len(c) - c.null_count for c in batch.columns if not pa.types.is_integer(c.type)))
                    yield batch

            yield from compare(look())

        return count

    monkeypatch.setattr(jaccard_join, "_comparer", counting)
    monkeypatch.setattr(jaccard_join, "SHARE_PAIRS", share)
    found = spark.createDataFrame([(a, b, 1) for a, b in combinations(range(30), 2)], "a long, b long, meeting long")
    links = jaccard_join._verified(found, spark.createDataFrame(rows, "doc_id long, text string"), like).collect()
    joined = jaccard_join.Union(30)
    for a, b in links:
        joined.join(a, b)
    same = {(i, j) for i, j in combinations(range(30), 2) if joined.find(i) == joined.find(j)}
    of = {doc: component for doc, _, component in brute(rows, like)}
    assert same == {(i, j) for i, j in combinations(range(30), 2) if of[i] == of[j]}
    assert seen.value == texts if texts else 30 < seen.value < 2 * 435


def test_only_texts_that_are_asked_for_pass(spark):
    """Else every text is shuffled to the few pairs of a pass."""
    texts = spark.range(-10_000, 10_000).selectExpr("id AS doc_id", "string(id) AS text")
    ids = [-10_000, -77, 0, 4711, 9_999]
    passed = jaccard_join._marked(texts, spark.createDataFrame([(i,) for i in ids], "a long"))
    assert passed.columns == ["doc_id", "text"]
    found = {r.doc_id for r in passed.collect()}
    assert found.issuperset(ids) and len(found) < 50
    assert jaccard_join._marked(texts, spark.createDataFrame([], "a long")).isEmpty()
