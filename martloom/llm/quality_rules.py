"""Line-first cleaning: judge every line, drop the failing ones, then judge what was lost.

Native: one narrow pass of DataFrame functions without a shuffle, so that hot sources and
copies cost what other rows cost.

Defined cases: a null or empty text has no words and is rejected (fewer than ten words);
a repeated row is judged by itself, like any other; other columns pass through
``measure`` untouched, those of the names it adds are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import LOWER, UPPER, WHITE, let, lower_ascii, table, words

MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of words inside repeated windows
REPEAT_WINDOW = 5
MAX_LOST = 50  # per cent of words in failing lines
SHORT_LINE = 4  # words up to which a line without closing punctuation fails
NAV_WORDS = 12  # words up to which a line of separators is navigation
BOILERPLATE_WORDS = 30  # words up to which a phrase makes a line boilerplate
SYMBOLS = "#*$%&|<>"

# Patterns on lower-cased lines, for Spark and for the oracle.
HAS_WORD = r"[^\x20\x09-\x0D]"
CLOSED = r"[.!?:;,…。！？»”\"')\]][\x20\x09-\x0D]*$"
NOT_LETTERS = r"[#*$%&|<>=~^_{}\\+@/-]"
SEPARATORS = r"[|>»·•].*[|>»·•].*[|>»·•]"
NAVIGATION_PHRASES = (
    "home|menu|login|log in|logout|sign in|sign up|register|search|next|previous|back|top|"
    "contact us|contact|about us|about|help|faq|sitemap|share|tweet|print|archive|skip to content"
)
NAVIGATION_GAP = r"[\x20\x09-\x0D|>»·•/,-]*"
NAVIGATION = rf"^[\x20\x09-\x0D]*(({NAVIGATION_PHRASES}){NAVIGATION_GAP})+$"
# The same without a way back, which Java matches in a loop: its plain repeated groups recurse, and
# a long line would end the executor. No phrase follows from another by a shorter choice before it.
NAVIGATION_LOOP = rf"^[\x20\x09-\x0D]*+(?:(?:{NAVIGATION_PHRASES}){NAVIGATION_GAP}+)++$"
BOILERPLATE = (
    r"(all rights reserved|terms of use|terms of service|privacy policy|cookie policy|use of cookies|lorem ipsum|"
    r"enable javascript|click here|read more|subscribe to our|powered by|copyright ©|copyright \(c\))"
)


def _repeat_words(tokens: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text."""
    window = F.lit(REPEAT_WINDOW)

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def places(pairs: Column) -> Column:
            last = F.size(pairs) - 1
            repeated = F.filter(
                pairs,
                lambda e, j: ((j > 0) & (F.get(pairs, j - 1)["h"] == e["h"]))
                | ((j < last) & (F.get(pairs, j + 1)["h"] == e["h"])),
            )
            return F.sort_array(F.transform(repeated, lambda e: e["i"]))

        def length(starts: Column) -> Column:
            steps = F.transform(
                starts,
                lambda s, j: F.when(
                    j < F.size(starts) - 1, F.least(window, F.get(starts, j + 1) - s)
                ).otherwise(window),
            )
            return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

        return let(let(ordered, places), length)

    def repeated(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ws) - REPEAT_WINDOW)
        hashes = F.transform(
            starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(REPEAT_WINDOW)])
        )
        return let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                covered(h)
            ),
        )

    return F.when(
        F.size(tokens) > REPEAT_WINDOW, let(tokens, repeated)
    ).otherwise(F.lit(0)).cast("long")


def _line_fails(line: Column) -> Column:
    """Whether a line, lower-cased and with a word, fails the punctuation, navigation or boilerplate rule."""

    def rules(n: Column) -> Column:
        signs = F.length(line) - F.length(F.regexp_replace(line, NOT_LETTERS, ""))
        solid = F.length(F.regexp_replace(line, WHITE, ""))
        punctuation = ((n <= SHORT_LINE) & ~line.rlike(CLOSED)) | (2 * signs > solid)
        navigation = ((n <= NAV_WORDS) & line.rlike(SEPARATORS)) | line.rlike(NAVIGATION_LOOP)
        boilerplate = (n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)
        return punctuation | navigation | boilerplate

    return let(F.size(words(line)), rules)


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with counts, ``base_failed``, ``n_lost_words``, ``cleaned`` text and ``kept``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(HAS_WORD))
    made = docs.withColumns({"_words": words(F.col("text")), "_lines": lines})
    judged = F.transform(
        "_lines",
        lambda line: let(
            lower_ascii(line),
            lambda low: F.struct(
                line.alias("line"), F.size(words(low)).alias("n"), _line_fails(low).alias("fails")
            ),
        ),
    )
    counted = made.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _repeat_words(F.col("_words")),
            "_judged": judged,
        }
    )
    kept_lines = F.filter("_judged", lambda e: ~e["fails"])
    lost = F.aggregate(
        "_judged",
        F.lit(0).cast("long"),
        lambda total, e: total + F.when(e["fails"], e["n"]).otherwise(F.lit(0)),
    )
    out = counted.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
            "n_lost_words": lost,
            "cleaned": F.array_join(F.transform(kept_lines, lambda e: e["line"]), "\n"),
        }
    )
    return out.withColumn(
        "kept",
        ~F.col("base_failed") & (100 * F.col("n_lost_words") <= MAX_LOST * F.col("n_words")),
    ).drop("_words", "_lines", "_judged")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return measure(docs).select("doc_id", *COUNTS, "base_failed", "kept")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


ORACLE = {
    "op6_quality_rules": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(t, {_quoted(WHITE)}), lambda x: x <> '') AS ws FROM d),
g AS (SELECT r, i, ws[i:i + 4] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM dup, range(5) AS k(k) GROUP BY r),
l AS (SELECT r, i, x FROM (SELECT r, unnest(string_split(t, chr(10))) AS x,
                                  unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i FROM d)
      WHERE regexp_matches(x, {_quoted(HAS_WORD)})),
m AS (SELECT r, translate(x, '{UPPER}', '{LOWER}') AS x,
             len(list_filter(regexp_split_to_array(x, {_quoted(WHITE)}), lambda y: y <> '')) AS n FROM l),
f AS (SELECT r, n,
       (n <= {SHORT_LINE} AND NOT regexp_matches(x, {_quoted(CLOSED)}))
       OR 2 * (length(x) - length(regexp_replace(x, {_quoted(NOT_LETTERS)}, '', 'g')))
          > length(regexp_replace(x, {_quoted(WHITE)}, '', 'g'))
       OR (n <= {NAV_WORDS} AND regexp_matches(x, {_quoted(SEPARATORS)}))
       OR regexp_matches(x, {_quoted(NAVIGATION)})
       OR (n <= {BOILERPLATE_WORDS} AND regexp_matches(x, {_quoted(BOILERPLATE)})) AS fails FROM m),
lost AS (SELECT r, sum(n) AS n FROM f WHERE fails GROUP BY r),
dl AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM l GROUP BY r),
c AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(list_aggregate(ws, 'string_agg', ''))::BIGINT AS word_chars,
       (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
       coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0) AS lost
      FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN dl USING (r) LEFT JOIN lost USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM c)
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= {MAX_LOST} * n_words AS kept FROM b
"""
}
