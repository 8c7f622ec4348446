"""License scans: base places against brute force, and the method on altered notices."""

from __future__ import annotations

import os
import random
import re

import pytest

from martloom.llm import license_scan as scans

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def base(text):
    """(n_words, places as (start, label)) by trying each phrase at each word."""
    tokens = words_of(text)
    found = []
    for phrase, label in scans.PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(tokens)) if tokens[i : i + len(parts)] == parts]
    return len(tokens), sorted(found)


def check_base(rows, texts):
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows]
    want = []
    for doc, text in texts:
        n, found = base(text)
        starts = [s for s, _ in found]
        labels = ",".join(sorted({label for _, label in found}))
        want.append((doc, n, len(found), min(starts, default=None), max(starts, default=None), labels))
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")
def test_base_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = scans.op12_license_scan(spark, SF_DIR).collect()
    check_base(rows, [tuple(r) for r in docs])
    assert any(r.labels for r in rows) and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def judged(spark, tmp_path, texts, schema="doc_id long, text string"):
    path = str(tmp_path / "t")
    spark.createDataFrame(texts, schema).write.parquet(f"{path}/documents.parquet")
    return scans.op12_license_scan(spark, path)


def test_odd_rows(spark, tmp_path):
    texts = [
        (1, None), (2, ""), (3, "cc by"), (4, "CC BY-NC CC by nc"), (4, "CC BY-NC CC by nc"), (4, "other words here"),
        (None, "Under the MIT License."), (5, "cc by nc " * 5000), (6, "x" * 300_000), (7, "Apache License, Version 2.0"),
        (8, "cc bé nc cc by ncx"), (9, "..."),
    ]
    rows = judged(spark, tmp_path, texts).collect()
    check_base(rows, texts)
    assert {r.labels for r in rows if r.doc_id == 5} == {"cc-by-nc"}


def test_empty_and_clashing_columns(spark, tmp_path):
    assert judged(spark, tmp_path / "a", []).count() == 0
    texts = [(1, "under the mit license", 7, "x", 3.5)]
    df = judged(spark, tmp_path / "b", texts, "doc_id long, text string, tag long, labels string, p double")
    assert [(r.n_base, r.labels) for r in df.collect()] == [(1, "mit")]


def noisy(rng, tokens, share):
    out = []
    for w in tokens:
        kind = rng.random()
        if kind < share / 3:
            continue
        out.append("qqq" if kind < 2 * share / 3 else w)
        if share * 2 / 3 <= kind < share:
            out.append("zzz")
    return out


def test_altered_notices(spark, tmp_path):
    """A notice with one word in 40 changed is found among other words; other text is not."""
    rng = random.Random(5)
    filler = [f"w{i}" for i in range(500)]
    texts, want = [], {}
    for n, (label, notice) in enumerate((lab, t) for lab, t in scans.NOTICES.items() if len(t.split()) >= 20):
        for copy in range(4):
            inside = noisy(rng, notice.split(), 0.025 if copy else 0)
            around = rng.sample(filler, 60)
            doc = 10 * n + copy
            texts.append((doc, " ".join([*around[:30], *inside, *around[30:]])))
            want[doc] = label
    for doc in range(1000, 1040):  # the same words in any order, and halves of notices
        shuffled = rng.choice(list(scans.NOTICES.values())).split()
        rng.shuffle(shuffled)
        texts.append((doc, " ".join(shuffled)))
    half = scans.NOTICES["mit"].split()
    texts.append((2000, " ".join(half[: len(half) // 2])))
    rows = {r.doc_id: r for r in judged(spark, tmp_path, texts).collect()}
    right = sum(rows[d].labels == label for d, label in want.items())
    assert right >= 0.95 * len(want)
    assert all(rows[d].labels == label and rows[d].score == 1.0 for d, label in want.items() if d % 10 == 0)
    assert not any(rows[d].labels for d in range(1000, 1040)) and rows[2000].labels == ""


def test_best_of_overlapping_and_repeats():
    known = scans.templates()

    def votes_of(text):
        tokens, votes = text.split(), {}
        for n, t in enumerate(known):
            for at in range(t.grams):
                for p in range(len(tokens) - scans.K + 1):
                    if tuple(tokens[p : p + scans.K]) == t.words[at : at + scans.K]:
                        votes.setdefault((n, p - at), set()).add(at)
        return [(n, d, sorted(places)) for (n, d), places in votes.items()]

    two = "this work is licensed under the gnu general public license version 2 and then licensed under the gnu general public license version 3"
    found = scans.judge(known, votes_of(two))
    assert [(f.label, f.start, f.score) for f in found] == [("gpl-2", 3, 1.0), ("gpl-3", 14, 1.0)]
    notice = scans.NOTICES["isc"]
    found = scans.judge(known, votes_of(" ".join([notice] * 3)))
    size = len(notice.split())
    assert [(f.label, f.start, f.end) for f in found] == [("isc", n * size, (n + 1) * size) for n in range(3)]
