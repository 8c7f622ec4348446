"""Secrets: base rules against plain patterns, and the network's held-out accuracy."""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pytest

from martloom.llm import secrets

SF_DIR = "/root/testdata/sf0.1"


def brute(text):
    """The contract's patterns as written: all matches, failing ones dropped afterwards."""
    text = text or ""
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    spans = []
    for m in re.finditer(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, m.end(), "assign"))
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


EDGES = [
    "token = 'abcdef' PassWord:x12345 API_KEY==abc secret \": 'short", "ſecret=abcdefg toKen=abcdefg",
    "AKIA" + "A1" * 8 + " AKIAAKIA" + "B" * 16 + " AKIA123", "0" * 24 + "g" + "f" * 23 + "AKIA" + "a" * 30,
    "tokentoken=tokentoken=abcdef", "😀 token=\"" + "a" * 40_000, "", None, " ", "password=" * 2000,
]


def check(rows, texts):
    for r in rows:
        spans = brute(texts[r.doc_id])
        assert [(s.start, s.end, s.kind) for s in r.base] == [(a, b, k) for a, _, b, k in spans]
        assert {(s.start, s.end, s.kind) for s in r.base} <= {(s.start, s.end, s.kind) for s in r.spans}


def test_edges(spark):
    texts = dict(enumerate(EDGES))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "'x' AS base")
    assert secrets.learn(df.limit(0)) is None
    rows = secrets.scan(df, None).collect()
    assert len(rows) == len(EDGES)
    check(rows, texts)
    clean = {r.doc_id: r.text for r in secrets.redact(df, None).collect()}
    assert clean[7] is None and clean[0] == "[SECRET]' [SECRET] API_KEY==abc secret \": 'short"
    assert secrets.scan(df.limit(0), None).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")
def test_sample_and_held_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = secrets.op3_secrets(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[3] == k for s in spans) for k in secrets.KINDS[:3]]
        assert set(filter(None, listed(spans).split(","))) <= set(r.spans.split(","))
    assert sum("network" in r.spans and not r.base_sha256 for r in rows) == 0

    net = secrets.learn(docs.where("doc_id % 2 = 0"))
    views, labels = [], []
    for doc_id, text in texts.items():
        if doc_id % 2:
            spans = secrets.base_spans(text)
            for start, end in secrets.candidates(text):
                views.append(secrets.view(text, start, end))
                labels.append(secrets._overlaps(start, end, spans))
    passed, labels = net.probability(secrets.encode(views)) >= net.threshold, np.array(labels)
    assert passed[labels].mean() >= 0.9 and passed[~labels].mean() <= 0.02
    # Known by its characters where no rule's word stands near.
    bare = secrets.view("x " + "9f86d081884c7d659a2f" + " y", 2, 22)
    card = secrets.view("x 4539148803436467 y", 2, 18)
    sure = net.probability(secrets.encode([bare, card]))
    assert sure[0] > sure[1]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 97, (6, secrets.WIDTH))
    labels = np.array([0, 1, 0, 1, 1, 0], np.float32)
    shapes = [(97, 8), (45, 16), (16,), (16,), (1,)]
    weights = [rng.normal(0, 0.3, s) for s in shapes]

    def loss(ws):
        logits = secrets.Network(*ws).forward(codes)[0]
        return np.mean(np.log1p(np.exp(logits)) - labels * logits)

    for n, g in enumerate(secrets._gradients(secrets.Network(*weights), codes, labels)):
        for at in [tuple(rng.integers(0, d) for d in shapes[n]) for _ in range(8)]:
            up = [w.copy() for w in weights]
            down = [w.copy() for w in weights]
            up[n][at] += 1e-5
            down[n][at] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - g[at]) < 1e-4


def test_every_finding_takes_part(spark, monkeypatch):
    """Each of several shards trains, all findings in one of them, and the model is the same on other partitions."""
    made = [(n, f"password = x{n}{hashlib.md5(b'%d' % n).hexdigest()[:18]} file-{n:05}-of-99999.png") for n in range(300)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    seen = spark.sparkContext.accumulator(0)
    fit = secrets.fit

    def counting(codes, *more):
        seen.add(len(codes))
        return fit(codes, *more)

    monkeypatch.setattr(secrets, "fit", counting)
    net = secrets.learn(docs, shard=150)
    assert seen.value > 2 * 3 * 300  # three rounds of more than 300 findings, each also bare
    other = secrets.learn(docs.repartition(7), shard=150)
    assert all(np.array_equal(a, b) for a, b in zip(net, other))
    views = [(secrets.view(t, *c), secrets._overlaps(*c, secrets.base_spans(t))) for _, t in made for c in secrets.candidates(t)]
    passed = net.probability(secrets.encode([v for v, _ in views])) >= net.threshold
    labels = np.array([label for _, label in views])
    assert passed[labels].mean() >= 0.9 and passed[~labels].mean() <= 0.1
