"""Personal data: base rules against plain regular expressions, disclosure against counts."""

from __future__ import annotations

import hashlib
import os
import re
import time

import pytest

from martloom.llm.pii import KINDS, _every, find, op10_pii, sanitise

SF_DIR = "/root/testdata/sf0.01"

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    spans = []
    for at, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m.group()):
                spans.append((m.start(), at, m.end(), kind))
    return sorted(spans)


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


EDGES = [
    "mail a.b%c@x-y.example.com, a@b.c_d@e.f and @x.y a@b a@b. 😀 z@q.r",
    "1.2.3.4 256.1.1.1 001.002.003.004.5.6.7.8 1.2.3 9999999999999999.1.1.1 1.2.3.4.5",
    "4539 1488 0343 6467 4539148803436467 1234-5678 79927398713 4539148803436467 0000",
    "+1 (017) 555-7713. +12 +1234567890123456 +1(((2 345 678 90))) ++1 222 333 4444",
    "", None, "   ", "9" * 30_000, "a" * 30_000 + "@", "a@" + "b." * 5_000 + "c", "1.1.1.1" * 300,
]


def test_edges(spark):
    docs = [(i, t, "x") for i, t in enumerate(EDGES)] + [(None, EDGES[0], "y"), (0, EDGES[0], "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, base string")
    got = {(r.doc_id): r.base for r in sanitise(df).collect()}
    for doc_id, text, _ in docs:
        assert [(s.start, s.at, s.end, s.kind) for s in got[doc_id]] == brute(text), doc_id
    assert sanitise(df.limit(0)).count() == 0


def test_many_matches_in_one_text(spark):
    """Work grows with the text, not with its square; neighbouring addresses share characters."""
    texts = [
        "plain words " * 50_000 + "a@b.c",
        " ".join(f"user{i}@mail{i}.example.com" for i in range(16_000)),
        "".join(f"a{i}@b.c%x@d.e" for i in range(3_000)),
        " ".join(f"10.0.{i % 256}.{i % 199}" for i in range(20_000)),
        "x" * 10_000 + "@" + "y" * 10_000,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    started = time.time()
    got = {r.doc_id: r.base for r in find(df).select("doc_id", _every(KINDS).alias("base")).collect()}
    assert time.time() - started < 60
    for i, text in enumerate(texts):
        assert [(s.start, s.at, s.end, s.kind) for s in got[i]] == brute(text)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")
def test_base_of_the_sample(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op10_pii(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in PATTERNS]
        assert set(listed(spans).split(",")) <= set(r.spans.split(","))
        assert spans or not r.spans


def test_disclosing_words(spark):
    """Words beside one address in several texts, and hardly elsewhere, disclose it."""
    mail = "ann.lee@mail.example.com"
    rows = [(i, f"Report {i} on the Zanzibar project: ask {mail} for plans, note {i}{i}.") for i in range(4)]
    rows += [(10 + i, f"the project of plain notes, ask for plans number {i} x{i}") for i in range(400)]
    rows += [(600, f"only here: Quokka {mail}"), (601, "Zanzibar again")] + [(700 + i, rows[0][1]) for i in range(5)]
    got = {r.doc_id: r for r in sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    terms = {s.value for r in got.values() for s in r.spans if s.kind == "term"}
    assert "Zanzibar" in terms and not terms & {"project", "plans", "the", "Quokka", "ask"}
    assert mail not in got[0].text and "Zanzibar" not in got[0].text
    assert got[10].text is None and got[601].text is None and not got[601].spans
