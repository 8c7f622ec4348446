"""License scans by diagonal voting.

1. Every rolling gram of ``K`` words of every text is a row, joined by its hash to the
   places of the templates' grams; the words themselves are compared in the same join, so a hash
   never decides alone. The templates are fixed and small, which bounds the broadcast side.
2. A shared gram at place p of the text and t of the template votes for the diagonal p - t.
   Votes are aggregated by (document, template, diagonal); a diagonal has as many as the
   template has grams, at most.
3. A phrase is found where its diagonal has all its votes. For a license text the votes of
   neighbouring diagonals are merged, as each inserted or lost word moves to the next one;
   from the strongest diagonal on, regions with enough merged votes become candidates.
4. A candidate is verified on its grams, whose words are known to be equal: the longest run
   of them that rises in text and template. Its score is the share of words that the run covers,
   of the template or of the span in the text, whichever is longer. From ``ACCEPTED`` on it
   is a finding; where findings of several templates overlap the best one stays.

Only places with shared grams are ever shuffled, and in them a document's rows are bounded
by its words, so a template that every document holds makes no hot group.

Defined cases: a null or empty text has no words and no labels; a null doc_id is a document
like others; rows equal in doc_id and text are judged once and returned each; ties between
findings go to the longer one, then to the label in byte order; an empty table gives no rows;
other columns are not read. Texts may have any length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import Scratch, let, lower_ascii, table, text_tag, words

K = 3
DRIFT = 4  # diagonals that are merged, to either side
VOTES = 0.4  # share of a template's grams that a candidate has at least
ACCEPTED = 0.8

#: Fixed value: what is between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases of the base rules.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notices of public licenses, as words.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the rights "
    "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to "
    "whom the software is furnished to do so subject to the following conditions",
    "apache-2": "you may not use this file except in compliance with the license you may obtain a copy of the license at "
    "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software "
    "distributed under the license is distributed on an as is basis without warranties or conditions of any kind either "
    "express or implied",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl-2": "licensed under the gnu general public license version 2",
    "gpl-3": "licensed under the gnu general public license version 3",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version",
    "lgpl": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
    "general public license as published by the free software foundation either version",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
    "not distributed with this file you can obtain one at",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify "
    "publish use compile sell or distribute this software",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
}


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    phrase: bool  # found as it stands or not at all

    @property
    def grams(self) -> int:
        return len(self.words) - K + 1


@dataclass(frozen=True)
class Finding:
    """A template in a text: words ``start`` to ``end`` (exclusive)."""

    label: str
    start: int
    end: int
    score: float
    phrase: bool


def templates(phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> list[Template]:
    made = [Template(label, tuple(text.split()), True) for text, label in phrases.items()]
    made += [Template(label, tuple(text.split()), False) for label, text in notices.items()]
    if any(t.grams < 1 for t in made):
        raise ValueError(f"a template needs {K} words")
    return made


# --- judging the votes of one document --------------------------------------------------------


def _rising(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of (place in text, place in template) that rises in both."""
    ends: list[int] = []  # least template place at which a run of each length ends
    tops: list[int] = []  # index of that hit
    before: list[int] = []
    ordered = sorted(hits, key=lambda h: (h[0], -h[1]))  # of one text place only one is taken
    for i, (_, t) in enumerate(ordered):
        at = bisect_left(ends, t)
        before.append(tops[at - 1] if at else -1)
        if at == len(ends):
            ends.append(t)
            tops.append(i)
        else:
            ends[at], tops[at] = t, i
    run, i = [], tops[-1] if tops else -1
    while i >= 0:
        run.append(ordered[i])
        i = before[i]
    return run[::-1]


def _covered(starts: list[int]) -> int:
    """Words that grams at rising ``starts`` cover."""
    return K * len(starts) - sum(max(0, K - (b - a)) for a, b in zip(starts, starts[1:]))


def _notice(template: Template, diagonals: dict[int, list[int]]) -> Iterator[Finding]:
    """Verified findings of one license text, regions with the most votes first."""
    order = sorted(diagonals)
    sums = [0, *accumulate(len(diagonals[d]) for d in order)]
    hits = sorted((d + t, t) for d, places in diagonals.items() for t in places)
    judged: list[tuple[int, int]] = []  # disjoint regions of the text, sorted
    for d in sorted(order, key=lambda d: (-len(diagonals[d]), d)):
        merged = sums[bisect_right(order, d + DRIFT)] - sums[bisect_left(order, d - DRIFT)]
        if merged < VOTES * template.grams:
            continue
        first, last = d - DRIFT, d + len(template.words) + DRIFT
        at = bisect_right(judged, (d + len(template.words) // 2, 1 << 62)) - 1
        if at >= 0 and judged[at][1] > d + len(template.words) // 2:
            continue
        judged.insert(at + 1, (first, last))
        region = hits[bisect_left(hits, (first, -1)) : bisect_left(hits, (last, -1))]
        run = _rising([h for h in region if abs(h[0] - h[1] - d) <= DRIFT])
        start, end = run[0][0], run[-1][0] + K
        score = _covered([t for _, t in run]) / max(len(template.words), end - start)
        if score >= ACCEPTED:
            yield Finding(template.label, start, end, score, False)


def judge(known: list[Template], votes: list[tuple[int, int, list[int]]]) -> list[Finding]:
    """Findings of a document from its (template, diagonal, template places).

    Phrases all stay; of overlapping license texts the best one does.
    """
    by_template: dict[int, dict[int, list[int]]] = defaultdict(dict)
    for template, diagonal, places in votes:
        by_template[template][diagonal] = places
    phrases, notices = [], []
    for n, diagonals in by_template.items():
        template = known[n]
        if not template.phrase:
            notices += _notice(template, diagonals)
            continue
        for d, places in diagonals.items():
            if len(places) == template.grams:
                phrases.append(Finding(template.label, d, d + len(template.words), 1.0, True))
    kept: list[Finding] = []
    taken: list[tuple[int, int]] = []  # sorted, disjoint
    for found in sorted(notices, key=lambda f: (-f.score, f.start - f.end, f.label, f.start)):
        at = bisect_left(taken, (found.start, found.end))
        free = (at == 0 or taken[at - 1][1] <= found.start) and (at == len(taken) or taken[at][0] >= found.end)
        if free:
            taken.insert(at, (found.start, found.end))
            kept.append(found)
    return sorted(phrases + kept, key=lambda f: (f.start, f.end, f.label))


# --- on Spark -------------------------------------------------------------------------------


def _template_grams(spark: SparkSession, known: list[Template]) -> DataFrame:
    """(gram, template, t, x0, x1, ...): a row a gram and place of a template."""
    rows = [(n, t, *template.words[t : t + K]) for n, template in enumerate(known) for t in range(template.grams)]
    parts = [f"x{k}" for k in range(K)]
    made = spark.createDataFrame(rows, "template int, t int, " + ", ".join(f"{x} string" for x in parts))
    return made.withColumn("gram", F.xxhash64(*parts))


def _grams(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, p, gram, w0, w1, ..., n_words): a row a gram, and one a document with p = -1."""
    hash_of = lambda w, p: F.xxhash64(*[F.get(w, p + k) for k in range(K)])
    words_of = lambda w, p: [F.get(w, p + k).alias(f"w{k}") for k in range(K)]
    none = [F.lit(None).cast("string").alias(f"w{k}") for k in range(K)]
    head = lambda w: F.array(F.struct(F.lit(-1).alias("p"), F.lit(0).cast("long").alias("gram"), F.size(w).alias("n_words"), *none))

    def rows(w):
        last = F.size(w) - K
        places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        here = F.transform(
            places,
            lambda p: F.struct(p.alias("p"), hash_of(w, p).alias("gram"), F.lit(0).alias("n_words"), *words_of(w, p)),
        )
        return F.concat(head(w), here)

    found = docs.select(
        "doc_id", text_tag(F.col("text")).alias("tag"), let(words(lower_ascii(F.col("text")), BETWEEN), rows).alias("g")
    )
    return found.select("doc_id", "tag", F.inline("g"))


_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("tag", pa.int64())]
    + [("findings", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("phrase", pa.bool_())])))]
)
FOUND = "doc_id long, tag long, findings array<struct<label string, start long, end long, score double, phrase boolean>>"


def _judge(known: list[Template]):
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                votes = [(v["template"], v["diagonal"], v["places"]) for v in row["votes"]]
                rows.append({"doc_id": row["doc_id"], "tag": row["tag"], "findings": [vars(f) for f in judge(known, votes)]})
            yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    return judged


def scan(docs: DataFrame, known: list[Template] | None = None) -> DataFrame:
    """(doc_id, tag, n_words, findings) of every row of (doc_id, text); findings by their place."""
    spark = docs.sparkSession
    known = known or templates()
    scratch = Scratch(spark, "license-scan")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    same = F.lit(True)
    for k in range(K):
        same = same & (F.col(f"w{k}") == F.col(f"x{k}"))
    grams = F.broadcast(_template_grams(spark, known).withColumnRenamed("gram", "of"))
    met = _grams(docs).join(grams, (F.col("gram") == F.col("of")) & same, "left")
    met = met.where("p < 0 OR t IS NOT NULL").select("doc_id", "tag", "p", "n_words", "template", "t")
    met = scratch.save(met, "met")

    votes = met.where("p >= 0").groupBy("doc_id", "tag", "template", (F.col("p") - F.col("t")).alias("diagonal"))
    votes = votes.agg(F.sort_array(F.collect_set("t")).alias("places"))
    by_doc = votes.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("template", "diagonal", "places")).alias("votes"))
    found = by_doc.mapInArrow(_judge(known), FOUND).selectExpr("doc_id AS of_id", "tag AS of_tag", "findings")
    heads = met.where("p < 0").select("doc_id", "tag", F.col("n_words").cast("long").alias("n_words"))
    joined = heads.join(found, F.expr("doc_id <=> of_id AND tag = of_tag"), "left")
    return joined.select("doc_id", "tag", "n_words", F.coalesce("findings", F.expr("array()")).alias("findings"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of all documents."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("findings", lambda f: f["phrase"])

    def labels(findings):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(findings, lambda f: f["label"]))), ",")

    places = F.transform(base, lambda f: f["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("findings")).alias("labels"),
        F.coalesce(F.array_max(F.transform("findings", lambda f: f["score"])), F.lit(0.0)).alias("score"),
    )
