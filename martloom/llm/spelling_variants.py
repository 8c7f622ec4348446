"""Spelling variant grouping with a variable-length gram index.

1. Words of all texts are counted. From here on the rows are distinct words.
2. Grams of ``SHORTEST`` to ``LONGEST`` code points are counted over the words. The dictionary
   keeps every shortest gram, and a longer one where the gram that it extends is frequent.
   Frequent grams are thus replaced by longer, rarer ones. ``DICTIONARY`` bounds the
   frequent grams and so the dictionary.
3. At each place a word has the longest gram of the dictionary that starts there. One edit can
   change the grams that hold its place and those that a changed text could make longer; the
   word's bound is the most grams that any edit affects. With ``LONGEST`` = 4 and words of
   six code points or more, at least one gram is left.
4. Near words share at least as many grams as either has unaffected ones. So a word's longest
   lists can be left out of the merge, as many as that number less one: the
   rest, its rarest grams, share at least one list with each near word. A shared gram lies
   before the edit, at the same distance from the start, or behind it, at the same distance
   from the end; lists are kept apart by that.
5. Lists of up to ``LIST`` words are merged by a join that verifies each pair at once. The
   words of longer lists are joined by the texts left when one code point is taken out instead:
   at most one row a code point, and a key that few words can share. Nothing is lost: a pair
   meets in a list, whatever its length.

Counting combines before its shuffle, so a word with a third of all places is one row a task.
Defined cases: a null text has no words, a null doc_id is written as nothing before the colon,
repeated rows count again, an empty table gives no rows, other columns are not read. Words
have no upper length; a long word has as many grams as code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import LOWER, UPPER, Scratch, lower_ascii, table
from martloom.llm.merkle_manifest import CRC_TABLE_SQL, crc_sql

#: What a run of letters is, once A-Z are lowered, and which runs change.
RUN = r"[a-z\u00C0-\u00FF]"
CHANGED = 199
LENGTH, OCCURRENCES, TIMES = 6, 5, 5
SHORTEST, LONGEST = 2, 4
DICTIONARY = 4096  # grams of one size that are extended, at most
LIST = 256  # words of a list that are merged pairwise


# --- words ----------------------------------------------------------------------------------


def changed_words(docs: DataFrame) -> DataFrame:
    """(word): every run of letters that is long enough, after the deletions."""
    # A run shorter than LENGTH stays so; a run of LENGTH or more matches as a whole.
    runs = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(RUN + "{%d,}" % LENGTH), F.lit(0))
    found = docs.select(F.col("doc_id").cast("string").alias("doc"), F.explode(runs).alias("run"))
    named = F.concat(F.coalesce("doc", F.lit("")), F.lit(":"), "run")
    found = found.select("run", F.crc32(named).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % CHANGED == 0, cut).otherwise(F.col("run"))
    return found.select(word.alias("word")).where(F.length("word") >= LENGTH)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that occur often enough."""
    return changed_words(docs).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= OCCURRENCES)


# --- dictionary -----------------------------------------------------------------------------


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, size, n) over the places of all words."""
    sizes = F.array(*[F.lit(q) for q in range(SHORTEST, LONGEST + 1)])
    fitting = F.transform(
        F.sequence(F.lit(1), F.length("word") - SHORTEST + 1),
        lambda p: F.transform(
            F.filter(sizes, lambda q: p + q <= F.length("word") + 1), lambda q: F.substr("word", p, q)
        ),
    )
    grams = words.select(F.explode(F.flatten(fitting)).alias("gram"))
    return grams.groupBy("gram", F.length("gram").alias("size")).agg(F.count("*").alias("n"))


def dictionary(counts: DataFrame) -> dict[str, int]:
    """Grams and their counts: all of the shortest, and longer ones that extend a frequent one.

    At most ``DICTIONARY`` grams of a size are extended, the most frequent ones, so that the
    dictionary is bounded by that and the alphabet, whatever the vocabulary. Which ones they are
    decides about the lengths of lists only, never about what is found.
    """
    made = {r["gram"]: r["n"] for r in counts.where(F.col("size") == SHORTEST).collect()}
    parents = set(made)
    for size in range(SHORTEST + 1, LONGEST + 1):
        parents = sorted(parents, key=lambda g: (-made[g], g))[:DICTIONARY]
        chosen = counts.sparkSession.createDataFrame([(g,) for g in parents], "parent string")
        parent = F.substr("gram", F.lit(1), F.lit(size - 1))
        rows = counts.where(F.col("size") == size).withColumn("parent", parent)
        found = {r["gram"]: r["n"] for r in rows.join(F.broadcast(chosen), "parent").collect()}
        made.update(found)
        parents = set(found)
    return made


class Grams:
    """The longest gram of the dictionary at each place of a word, and the word's bound."""

    def __init__(self, known: dict[str, int]):
        self.known = known
        self.prefixes = {g[:k] for g in known for k in range(1, len(g))}

    def of(self, word: str) -> list[str]:
        made = []
        for p in range(len(word) - SHORTEST + 1):
            size = SHORTEST
            while size < LONGEST and p + size < len(word) and word[p : p + size + 1] in self.known:
                size += 1
            made.append(word[p : p + size])
        return made

    def affected(self, word: str, grams: list[str]) -> int:
        """The most grams that one changed, deleted or inserted code point can affect."""
        most = 0
        for at in range(len(word) + 1):
            hit = 0
            for p in range(max(0, at - LONGEST + 1), min(at + 1, len(grams))):
                if p + len(grams[p]) > at or word[p:at] in self.prefixes:
                    hit += 1
            most = max(most, hit)
        return most


LISTED = "list string, word string, n long, length int"
_LISTED = pa.schema([("list", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("length", pa.int32())])


def _lister(known: dict[str, int]):
    grams_of = Grams(known)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for word, n in zip(*(c.to_pylist() for c in batch.columns)):
                grams = grams_of.of(word)
                left = len(grams) - grams_of.affected(word, grams)
                ranked = sorted(range(len(grams)), key=lambda p: (known[grams[p]], grams[p], p))
                for p in ranked[: len(grams) - max(left, 1) + 1]:
                    for side, place in (("<", p), (">", len(word) - p)):
                        out.append((f"{grams[p]}{side}{place}", word, n, len(word)))
            columns = list(zip(*out)) or [[] for _ in _LISTED]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LISTED)], schema=_LISTED)

    return lists


# --- pairs ----------------------------------------------------------------------------------


def _verified(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Pairs (a, b), a < b, that meet under a key and differ by exactly one code point."""
    a = left.select(on, F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("length").alias("a_length"))
    b = right.select(on, F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("length").alias("b_length"))
    near = (F.col("a") < F.col("b")) & (F.abs(F.col("a_length") - F.col("b_length")) <= 1)
    met = a.join(b, on).where(near).where(F.levenshtein("a", "b", 1) == 1)
    return met.select("a", "a_n", "b", "b_n")


def _with_one_out(words: DataFrame) -> DataFrame:
    """Keys under which near words meet: of the word, and of it with one code point taken out."""
    word = F.col("word")
    cut = F.transform(
        F.sequence(F.lit(1), F.col("length")),
        lambda p: F.xxhash64(F.concat(F.substr(word, F.lit(1), p - 1), F.substr(word, p + 1))),
    )
    keys = F.array_distinct(F.concat(F.array(F.xxhash64(word)), cut))
    return words.select(F.explode(keys).alias("key"), "word", "n", "length")


def near_pairs(words: DataFrame, scratch: Scratch, longest_list: int = LIST) -> DataFrame:
    """(a, a_n, b, b_n), a < b: all pairs of ``words`` (word, n) that differ by one code point."""
    known = dictionary(scratch.save(gram_counts(words), "grams"))
    listed = scratch.save(words.select("word", "n").mapInArrow(_lister(known), LISTED), "lists")
    sizes = listed.groupBy("list").agg(F.count("*").alias("size")).where("size > 1")
    sizes = scratch.save(sizes, "sizes")
    short = listed.join(sizes.where(F.col("size") <= longest_list).select("list"), "list")
    short = scratch.save(short, "short")
    long = listed.join(sizes.where(F.col("size") > longest_list).select("list"), "list", "left_semi")
    long = scratch.save(_with_one_out(long.select("word", "n", "length").distinct()), "long")
    pairs = _verified(short, short, "list").unionByName(_verified(long, long, "key"))
    return scratch.save(pairs.distinct(), "pairs")


# --- groups ---------------------------------------------------------------------------------


def variants(words: DataFrame, longest_list: int = LIST) -> DataFrame:
    """Every word of (word, n) with its near words, the form that it varies, and its root."""
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.save(words, "words")
    pairs = near_pairs(words, scratch, longest_list)
    both = pairs.toDF("word", "n", "other", "other_n").unionByName(pairs.select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left")
    often = -F.col("best.less") >= TIMES * F.col("n")
    found = scratch.save(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(often, F.col("best.word")).alias("form"),
            F.when(often, -F.col("best.less")).alias("form_n"),
        ),
        "found",
    )
    # A form occurs TIMES as often as its word, so the most frequent word bounds every chain;
    # each round doubles the steps that a pointer covers.
    most = found.agg(F.max("n")).first()[0] or 1
    steps, covered = floor(log(most, TIMES)) + 1, 1
    roots = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while covered < steps:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        roots = scratch.save(roots, f"roots-{covered}")
        covered *= 2
    return found.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text")))


ORACLE = {
    "op13_spelling_variants": f"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run
  FROM documents),
named AS (
  SELECT run, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs WHERE length(run) >= {LENGTH}),
hashes AS (
  SELECT run, {crc_sql("[('0x' || substr(x, i::BIGINT, 2))::BIGINT FOR i IN range(1, length(x), 2)]")} AS h
  FROM named, crc_table),
words AS (
  SELECT word, count(*) AS n
  FROM (SELECT CASE WHEN h % {CHANGED} = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT)
                    ELSE run END AS word FROM hashes)
  WHERE length(word) >= {LENGTH} GROUP BY word HAVING count(*) >= {OCCURRENCES}),
cut AS (
  SELECT word, length(word) AS l, p, left(word, p - 1) || substr(word, p + 1) AS rest
  FROM words, unnest(range(1, length(word) + 1)) AS places(p)),
pairs AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.p = b.p AND a.rest = b.rest AND a.l = b.l AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.rest = b.word),
near AS (
  SELECT p.word, count(*) AS n_near, arg_min({{'w': p.other, 'n': o.n}}, {{'less': -o.n, 'w': p.other}}) AS best
  FROM pairs p JOIN words o ON o.word = p.other GROUP BY p.word),
forms AS (
  SELECT word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best.n >= {TIMES} * w.n THEN best.w END AS form,
         CASE WHEN best.n >= {TIMES} * w.n THEN best.n END AS form_n
  FROM words w LEFT JOIN near USING (word)),
steps(word, root, step) AS (
  SELECT word, word, 0 FROM forms
  UNION ALL SELECT s.word, f.form, step + 1 FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN roots USING (word)
"""
}
