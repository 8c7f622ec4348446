"""URL filters, quality rules, decontamination and the fixity audit on small fixtures."""

from __future__ import annotations

import random

from martloom.llm import decontamination, quality_rules, url_filters, warc_audit

PAGES = "page_id long, url string, html string"


def judged(spark, rows, **kwargs):
    out = url_filters.judge(spark.createDataFrame(rows, PAGES), **kwargs).collect()
    return {r.page_id: (r.rule, r.verdict) for r in out}


def test_blocks_reach_aliases_and_allows_go_first(spark):
    refresh = '<meta http-equiv="refresh" content="0; url={}">'.format
    rows = [
        (1, "https://a.net/x", refresh("https://b.com/de/1")),  # alias of a blocked url
        (2, "https://c.net/y", '<link rel="canonical" href="https://a.net/x">'),  # alias of an alias
        (3, "https://b.com/de/1", None),
        (4, "https://d.net/z", refresh("https://b.com/de/2")),
        (5, "https://b.com/fr/2", refresh("https://d.net/z")),  # allowed by a rule, so is its component
        (6, "https://e.net/", ""),
        (7, None, None),
        (8, "no scheme", None),
        (8, "no scheme", None),
    ]
    got = judged(spark, rows)
    assert [got[n][1] for n in (1, 2, 3, 4, 5, 6, 7, 8)] == ["block"] * 3 + ["allow"] * 5
    assert got[3][0] == "com/de/" and got[5][0] == "com/fr/" and got[1][0] is None
    seen = spark.createDataFrame([("https://e.net/", "https://b.com/de/1"), (None, "x")], "source string, target string")
    assert judged(spark, rows, redirects=seen)[6][1] == "block"
    assert judged(spark, [r for r in rows if False]) == {}


def test_blocks_reach_other_spellings(spark):
    """Without any edge: a port or an empty path names the same resource, but not the same rule."""
    rows = [
        (1, "https://example.org/es/x", None), (2, "https://example.org:443/es/x", None), (3, "http://b.com:80/de/1", None),
        (4, "http://b.com/de/1", None), (5, "https://a.net", None), (6, "https://a.net/", None), (7, "https://x.org:443/y", None),
        (8, "https://example.org:443/es/other", None),
    ]
    got = judged(spark, rows)
    assert [got[n][1] for n in range(1, 9)] == ["block", "block", "block", "block", "allow", "allow", "allow", "block"]
    assert got[2][0] is None


def test_many_aliases_chains_and_cycles(spark):
    """A hub of aliases, a long chain, a cycle; one blocked url decides for all of them."""
    seen = [(f"https://hub{n}.net/", "https://b.com/de/hub") for n in range(5_000)]
    seen += [(f"https://chain.net/{n}", f"https://chain.net/{n + 1}") for n in range(300)] + [("https://chain.net/300", "https://b.com/de/end")]
    seen += [(f"https://ring.net/{n}", f"https://ring.net/{(n + 1) % 50}") for n in range(50)]
    rows = [(n, url, None) for n, (url, _) in enumerate(seen)]
    redirects = spark.createDataFrame(seen, "source string, target string")
    got = judged(spark, rows, redirects=redirects)
    assert all(got[n][1] == "block" for n in range(5_301)) and all(got[n][1] == "allow" for n in range(5_301, 5_351))


def test_odd_pages(spark):
    long = "https://b.com/de/" + "x" * 200_000
    rows = [(1, long, "", 5, "c"), (1, long, "", 5, "c"), (2, "https://Example.ORG/en/1?a=b#c", None, None, None), (3, "", "", 1, "d")]
    df = spark.createDataFrame(rows, PAGES + ", node long, component string")
    out = url_filters.judge(df).collect()
    assert sorted((r.page_id, r.rule, r.verdict) for r in out if r.rule) == [
        (1, "com/de/", "block"), (1, "com/de/", "block"), (2, "example.org/en/1", "block"),
    ] and len(out) == 4


def test_quality_of_odd_texts(spark):
    sentence = "A plain sentence that has more than ten words in it, and ends."
    texts = [None, "", " \n ", sentence, f"{sentence}\nHome | About | Help | Login", "spam " * 60, "a b c.\n" * 20]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    got = {r.doc_id: r for r in quality_rules.measure(docs).collect()}
    assert [got[i].kept for i in range(7)] == [False, False, False, True, True, False, False]
    assert got[4].cleaned == sentence and got[5].n_repeat_words == 60 and got[6].n_dup_lines == 19


def test_quality_of_very_long_lines(spark):
    """A line of 10^5 words, navigation or not; Java recurses in repeated groups."""
    many = 100_000
    texts = ["home " * many, "home " * many + "x", "contact us | " * many, "| " * many, "x" * 1_000_000, "about " * many + "us"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_lost_words) for r in quality_rules.measure(docs).collect()}
    assert got == {
        0: (many, many), 1: (many + 1, 0), 2: (3 * many, 3 * many), 3: (many, many), 4: (1, 1), 5: (many + 1, many + 1),
    }
    empty = quality_rules.measure(docs.limit(0)).count()
    again = quality_rules.measure(docs.where("doc_id = 4").union(docs.where("doc_id = 4"))).collect()
    assert empty == 0 and len(again) == 2 and again[0] == again[1]


def test_navigation_without_a_way_back_is_the_same(spark):
    rng = random.Random(2)
    parts = [*quality_rules.NAVIGATION_PHRASES.split("|"), "us", "x", " ", " | ", "/", "-", ">", "log", "in"]
    lines = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(20_000)]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    both = df.selectExpr("line", f"line RLIKE r'{quality_rules.NAVIGATION}' AS a", f"line RLIKE r'{quality_rules.NAVIGATION_LOOP}' AS b")
    assert both.where("a <> b").count() == 0 and both.where("a").count() > 1000


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefg")
    items = [(f"i{n}", " ".join(word() for _ in range(rng.choice([3, 13, 16])))) for n in range(12)]
    items += [("none", None), ("empty", ""), (None, "q r s")]
    docs = [(n, " ".join(word() for _ in range(60))) for n in range(20)]
    docs += [(50 + n, f"X {text} Y") for n, (_, text) in enumerate(items[:12])] + [(70, None), (71, ""), (72, "q R s t"), (72, "q R s t")]
    got = decontamination.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    ).collect()
    found = {(r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in got}
    assert found == {by_hand(d, t, items) for d, t in docs}


def by_hand(doc, text, items):
    words = (text or "").lower().split()
    hit, named = set(), set()
    for item, passage in items:
        of = (passage or "").lower().split()
        size = min(13, len(of))
        windows = {tuple(of[i : i + size]) for i in range(len(of) - size + 1)} if of else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                named.add(item)
    return doc, len(words), len(hit), tuple(sorted(named - {None}))


def test_audit_finds_what_differs(spark):
    pages = [(n, f"https://a.net/{n}", "<p>" + "x" * (n % 50)) for n in range(500)] + [(700, None, None)]
    records = warc_audit.warc_records(spark.createDataFrame(pages, PAGES)).cache()
    assert warc_audit.audit(records, records).count() == 0
    assert warc_audit.audit(records.limit(0), records.limit(0)).count() == 0
    faults = [r.fault for r in warc_audit.audit(records, warc_audit.damaged(records)).collect()]
    kinds = [n % 211 for n, _, _ in pages]
    assert faults.count("corrupt") == kinds.count(7) and faults.count("added") == kinds.count(13)
    assert faults.count("missing") == kinds.count(13) + kinds.count(101)
