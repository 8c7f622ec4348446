"""The pipeline's stages against brute force on a small fixture, and its contract."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import Row
from test_jaccard import brute
from test_packing import check

import corpus_pipeline
from martloom.llm import secrets

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = docs.limit(1).selectExpr("cast(null AS long) doc_id", "text", "lang", "source", "n_chars")
    current = docs.unionByName(docs.limit(3)).unionByName(odd).unionByName(
        odd.selectExpr("5000L doc_id", "cast(null AS string) text", "lang", "source", "n_chars")
    )
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, current, SF_DIR)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        path = str(tmp_path / name)
        out.write.parquet(path)
        before = [tuple(r) for r in current.collect()]
        result = spark.read.parquet(path)
        after = [tuple(r) for r in result.collect()] if name != "packing" else result.collect()
        if name == "quality_rules":
            assert 0 < len(after) < len(before) and set(after) <= set(before)
        if name == "jaccard_join":
            parts = brute([r[:2] for r in before], corpus_pipeline.NEAR)
            stay = {d for d, _, c in parts if d == c and d is not None}
            assert sorted(r[0] for r in after if r[0] is not None) == sorted(stay)
            assert sum(r[0] is None for r in after) == sum(r[0] is None for r in before)
        if name == "decontamination":
            assert set(after) <= set(before) and len(after) < len(before)
        if name == "secrets":
            by_id = {r[0]: r for r in before}
            assert len(after) == len(before)
            for r in after:
                old = by_id[r[0]][1]
                assert r[1] == old or secrets.MASK in r[1]
                assert not secrets.base_spans(r[1]) and (r[1] == old) == (not secrets.base_spans(old))
                assert r[4] == len(r[1])
        if name == "packing":
            # Texts without an id share it, so they are told apart by an id of their own here.
            named = [(r[0] if r[0] is not None else -1, r[1]) for r in before]
            pieces = [r.asDict() | {"doc_id": -1 if r.doc_id is None else r.doc_id} for r in after]
            assert sum(d == -1 for d, _ in named) == 1
            used, least = check(named, [Row(**r) for r in pieces], 2048)
            assert used <= least + 2
        current = result


def test_stages_of_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
