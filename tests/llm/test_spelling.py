"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import os
import random
import re
import zlib
from collections import Counter

import pytest
from oracle_compare import compare

from martloom.llm import spelling_variants as spelling

SF_DIR = "/root/testdata/sf0.001"


def words_of(docs):
    counts = Counter()
    for doc, text in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            hashed = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if hashed % 199 == 0:
                at = hashed % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(words):
    out, forms = {}, {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 5 * n:
            forms[w] = best
        out[w] = [n, len(others), forms.get(w), words.get(forms.get(w))]
    for w in words:
        root = w
        while root in forms:
            root = forms[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def result(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def vocabulary(rng, size, alphabet="abc", lengths=(6, 10)):
    words = {}
    while len(words) < size:
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(*lengths)))
        words[word] = rng.choice([5, 6, 25, 30, 150, 800, 5000])
    return words


@pytest.mark.parametrize("longest_list", [spelling.LIST, 3, 0])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijéÿ"])
def test_all_pairs(spark, longest_list, alphabet):
    """Dense words, so that most lists are hot, and sparse ones; every way of merging a list."""
    words = vocabulary(random.Random(len(alphabet)), 400 if alphabet == "ab" else 150, alphabet)
    if alphabet != "ab":  # one edit each
        rng = random.Random(1)
        for w in list(words)[:100]:
            at = rng.randrange(len(w))
            words[rng.choice([w[:at] + w[at + 1 :] + "j", w[:at] + "ÿ" + w[at:], w[:at] + "j" + w[at + 1 :]])] = rng.choice([5, 40, 700])
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.variants(df, longest_list)) == brute(words)


@pytest.mark.parametrize("bound", [0, 2, 4096])
def test_any_dictionary(spark, monkeypatch, bound):
    monkeypatch.setattr(spelling, "DICTIONARY", bound)
    words = vocabulary(random.Random(bound), 200, "abcd", (6, 7))
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.variants(df)) == brute(words)


def test_affected_is_a_bound():
    """No edit leaves fewer grams in place than the word's bound says."""
    rng = random.Random(3)
    known = {a + b: 1 for a in "abc" for b in "abc"}
    known |= {g + c: 1 for g in list(known) if rng.random() < 0.6 for c in "abc" if rng.random() < 0.7}
    known |= {g + c: 1 for g in list(known) if len(g) == 3 and rng.random() < 0.5 for c in "abc" if rng.random() < 0.7}
    grams = spelling.Grams(known)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(6, 9)))
        mine = grams.of(word)
        bound = grams.affected(word, mine)
        assert bound <= spelling.LONGEST
        for at in range(len(word) + 1):
            edits = [(word[:at] + c + word[at:], 1) for c in "abc"]
            if at < len(word):
                edits += [(word[:at] + c + word[at + 1 :], 0) for c in "abc"] + [(word[:at] + word[at + 1 :], -1)]
            for other, shift in edits:
                theirs = dict(enumerate(grams.of(other)))
                same = 0
                for p, g in enumerate(mine):
                    same += theirs.get(p if p < at else p + shift) == g
                assert same >= len(mine) - bound


def test_chain_of_forms(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625, "bbbbbb": 78125}
    got = result(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words) and got["aaaaaa"][-1] == "bbbbbb"


def test_words_and_odd_rows(spark):
    docs = [
        (n, f"Colours and colors, Héllos {'x' * n} won't naïvely Éclairs 12 theatre\ntheater 中文")
        for n in range(300)
    ] + [(None, "colours " * 9), (7, None), (8, ""), (9, "Colours " * 400), (9, "Colours " * 400), (10, "z" * 100_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.word: r.n for r in spelling.vocabulary(df).collect()} == words_of(docs)
    assert result(spelling.variants(spelling.vocabulary(df))) == brute(words_of(docs))


def test_long_words(spark):
    long = "".join(random.Random(2).choice("abcdef") for _ in range(20_000))
    words = {long: 5, long[:9000] + long[9001:]: 90, long[:-1] + "z": 7, "z" + long: 8, "abcdef": 9}
    for limit in (0, spelling.LIST):
        got = result(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"), limit))
        assert got == brute(words)


def test_empty_and_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, word double, n string, `list` int"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    assert spelling.op13_spelling_variants(spark, str(tmp_path / "a")).count() == 0
    rows = [(1, "colours " * 9 + "colour " * 50, 1.5, "x", 2)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    got = result(spelling.op13_spelling_variants(spark, str(tmp_path / "b")))
    assert got == brute(words_of([r[:2] for r in rows]))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")
def test_equals_sql(spark):
    name = "op13_spelling_variants"
    assert compare(spark, spelling.op13_spelling_variants, spelling.ORACLE[name], SF_DIR) == []
