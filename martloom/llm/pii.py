"""Information-theoretic sanitisation of personal data.

Base rules find e-mail and network addresses, card and phone numbers: the protected
entities. From the co-occurrence of words with entities over the whole corpus follows how
much a word tells about an entity: with ``n(t)`` the texts that hold word t, ``n(e)`` those
that hold entity e, ``n(t, e)`` both and N all, the pointwise mutual information is
``log2(N n(t, e) / (n(t) n(e)))`` and the chance to guess e from t is ``n(t, e) / n(t)``.
A word discloses e when both exceed their thresholds and at least ``SUPPORT`` different texts
bear it out. Where a text names the entity, its disclosing words are found as well: numbers
and capitalised words are removed, other words generalised to a placeholder.

Native: DataFrame functions only. Words that stand beside no entity are dropped inside the scan by a bitmap of fixed size, and what
is left is counted with partial aggregation: a frequent word is one row a task.

Words of fewer than ``TERM_CHARS`` characters are not judged. Copies count in ``n(e)`` and
``n(t, e)`` as in ``n(t)``; as evidence, in ``SUPPORT``, equal texts count once.

Defined cases: a null text is empty; repeated rows are judged alike; a null doc_id is a
document like others; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import Scratch, let, table, words

# The contract's kinds, in order. Repeats are possessive where nothing that
# follows could need their characters back, so that long runs stay linear and flat.
KINDS = ("email", "ip", "card", "phone")
#: From the start of a run of local characters, or what the match before left of it: other starts
#: of the run would reach the same end.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"[^\x20\x09-\x0D]+"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IS_IP = rf"^{PART}(?:\.{PART}){{3}}$"

SUPPORT = 3  # different texts in which a word stands beside an entity
GUESS = 0.5  # chance to guess the entity from the word
BITS_TOLD = 4.0  # pointwise mutual information
TERM_CHARS = 3  # shorter words are not judged
CHUNK = 128  # matches whose places are summed together
BITS = 23  # of the bitmap: 1 MB
PER_LONG = 6


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    figures = F.transform(F.reverse(F.split(digits, "")), lambda d: d.cast("int"))
    added = F.transform(
        figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    )
    return F.aggregate(added, F.lit(0), lambda a, d: a + d) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(IS_IP)
    digits = _digits(match)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)


def _found(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of all matches, from the pieces between them.

    An array that grows one by one is copied each time. So places are summed in chunks of
    ``CHUNK`` matches and chunks put one after the other: many matches stay near linear.
    """
    kind = "array<struct<start:int,end:int,value:string>>"

    def step(s: Column, pair: Column) -> Column:
        start = s["at"] + F.length(pair["p"])
        end = start + F.length(pair["m"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), pair["m"].alias("value")))
        return F.struct(end.alias("at"), F.concat(s["found"], one).alias("found"))

    def in_chunks(pairs: Column) -> Column:
        nothing = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(pairs), F.lit(1)), F.lit(CHUNK))
        return F.transform(firsts, lambda at: F.aggregate(F.slice(pairs, at, CHUNK), nothing, step))

    def joined(chunks: Column) -> Column:
        nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(
            chunks,
            nothing,
            lambda s, c: F.struct((s["at"] + c["at"]).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts")),
            lambda s: s["starts"],
        )

        def shifted(chunk: Column, at: Column) -> Column:
            return F.transform(
                chunk["found"],
                lambda x: F.struct((x["start"] + at).alias("start"), (x["end"] + at).alias("end"), x["value"].alias("value")),
            )

        return F.flatten(F.zip_with(chunks, starts, shifted))

    def placed(matches: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        pairs = F.filter(F.arrays_zip(pieces.alias("p"), matches.alias("m")), lambda x: x["m"].isNotNull())
        return let(let(pairs, in_chunks), joined)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


#: A text without the sign needs no search.
SIGNS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
SPANS = "array<struct<start:int,end:int,value:string>>"


def _passing(kind: str):
    return lambda x: _passes(kind, x["value"])


def _of(kind: str):
    return lambda x: x["kind"] == kind


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with an array of base findings (start, end, value) for each kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs
    for kind in KINDS:
        found = F.filter(_found(text, PATTERNS[kind]), _passing(kind))
        out = out.withColumn(kind, F.when(text.rlike(SIGNS[kind]), found).otherwise(F.array().cast(SPANS)))
    return out


def _terms(text: Column) -> Column:
    """Distinct words without surrounding punctuation."""
    bare = F.transform(words(text), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return F.array_distinct(F.filter(bare, lambda w: F.length(w) >= TERM_CHARS))


def _slot(term: Column) -> Column:
    return F.shiftright(F.xxhash64(term).bitwiseAND((1 << BITS) - 1), PER_LONG)


def _bit(term: Column) -> Column:
    place = F.xxhash64(term).bitwiseAND((1 << PER_LONG) - 1).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _bitmap(terms: DataFrame) -> DataFrame:
    """One row: always 2^17 longs."""
    longs = terms.groupBy(_slot(F.col("term")).alias("slot")).agg(F.bit_or(_bit(F.col("term"))).alias("bits"))
    slots = terms.sparkSession.range(1 << (BITS - PER_LONG)).withColumnRenamed("id", "slot")
    filled = slots.join(longs, "slot", "left").select("slot", F.coalesce("bits", F.lit(0)).alias("bits"))
    pairs = F.sort_array(F.collect_list(F.struct("slot", "bits")))
    return filled.agg(F.transform(pairs, lambda e: e["bits"]).alias("bits"))


def disclosures(found: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(entity, term) of the words that disclose an entity, by counts over all ``docs``.

    ``found`` are the documents with findings: (text, entities).
    """
    texts = found.groupBy("text").agg(F.count("*").alias("c"), F.first("entities").alias("entities"))
    pairs = texts.select("text", "c", F.explode("entities").alias("entity"))
    of_entity = pairs.groupBy("entity").agg(F.sum("c").alias("n_e"), F.count("*").alias("texts"))
    # An entity in too few texts cannot bear a word out.
    of_entity = of_entity.where(F.col("texts") >= SUPPORT).drop("texts")
    beside = pairs.join(of_entity, "entity")
    beside = beside.select("entity", "n_e", "c", F.explode(_terms(F.col("text"))).alias("term"))
    beside = beside.where(~F.col("entity").contains(F.col("term")))
    joint = beside.groupBy("entity", "term").agg(
        F.sum("c").alias("n_te"), F.count("*").alias("texts"), F.max("n_e").alias("n_e")
    )
    joint = scratch.save(joint.where(F.col("texts") >= SUPPORT), "joint")
    probed = docs.select("text").withColumn("bits", _bitmap(joint.select("term").distinct()).scalar())
    kept = F.filter(
        _terms(F.col("text")),
        lambda t: F.get(F.col("bits"), _slot(t).cast("int")).bitwiseAND(_bit(t)) != 0,
    )
    of_term = probed.select(F.explode(kept).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    told = joint.join(of_term, "term").withColumn("n_all", docs.agg(F.count("*").alias("n")).scalar())
    information = F.log2(F.col("n_all") * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    enough = (F.col("n_te") >= GUESS * F.col("n_t")) & (information >= BITS_TOLD)
    return told.where(enough).select("entity", "term")


def _term_spans(text: Column, terms: Column) -> Column:
    """Where the words ``terms`` stand in ``text``, without the punctuation around them."""

    def bare(w: Column) -> Column:
        ahead = F.regexp_extract(w["value"], r"^[^\p{L}\p{N}]*", 0)
        value = F.regexp_replace(w["value"], r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
        start = w["start"] + F.length(ahead)
        end = start + F.length(value)
        return F.struct(start.alias("start"), end.alias("end"), value.alias("value"))

    placed = F.transform(_found(text, WORD), bare)
    return F.filter(placed, lambda w: F.array_contains(terms, w["value"]))


def _every(kinds: tuple[str, ...]) -> Column:
    """All findings as (start, place of the kind, end, kind, value), in order."""

    def named(kind: str) -> Column:
        return F.transform(
            kind,
            lambda x: F.struct(
                x["start"].alias("start"), F.lit(kinds.index(kind)).alias("at"), x["end"].alias("end"),
                F.lit(kind).alias("kind"), x["value"].alias("value"),
            ),
        )

    return F.sort_array(F.concat(*[named(kind) for kind in kinds]))


def listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def _sanitised(text: Column, spans: Column) -> Column:
    """The text with findings as placeholders; disclosing names and numbers are removed."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        told = x["value"].rlike(r"^[\p{Lu}\p{N}]")
        mark = F.when((x["kind"] == "term") & told, "").otherwise(F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")))
        before = F.substr(text, s["at"] + 1, x["start"] - s["at"])
        inside = x["start"] < s["at"]  # an overlap: its first part is gone already
        out = F.when(inside, s["out"]).otherwise(F.concat(s["out"], before, mark))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), out.alias("out"))

    done = lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, state, step, done)).otherwise(text)


def sanitise(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans, text) of every document; ``text`` is null where nothing was found.

    ``base`` and ``spans`` are arrays of (start, at, end, kind, value); the latter holds the
    disclosing words as kind ``term`` as well.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    found = find(docs.select("doc_id", "text"))
    base = found.select("doc_id", "text", _every(KINDS).alias("base"))
    hit = F.size("base") > 0
    base = scratch.save(base.select("doc_id", F.when(hit, F.col("text")).alias("text"), "base"), "base")
    named = F.array_distinct(F.transform("base", lambda x: x["value"]))
    held = base.where(hit).select("doc_id", "text", "base", named.alias("entities"))
    told = disclosures(held.select("text", "entities"), docs.select("text"), scratch)
    # One list an entity, of the words of texts that name it; bounded by such a text's words.
    told = scratch.save(told, "told")
    texts = held.select("text", F.explode("entities").alias("entity")).distinct()
    terms = (
        texts.join(told, "entity").where(F.col("text").contains(F.col("term")))
        .groupBy("text").agg(F.collect_set("term").alias("terms"))
    )
    joined = held.join(terms, "text", "left")
    none = F.array().cast(SPANS)
    spans = F.when(F.size("terms") > 0, _term_spans(F.col("text"), F.col("terms"))).otherwise(none)
    some = joined.select("doc_id", "text", "base", spans.alias("term"))
    added = F.transform(
        "term",
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(len(KINDS)).alias("at"), x["end"].alias("end"),
            F.lit("term").alias("kind"), x["value"].alias("value"),
        ),
    )
    some = some.select("doc_id", "text", "base", F.sort_array(F.concat("base", added)).alias("spans"))
    some = some.select("doc_id", "base", "spans", _sanitised(F.col("text"), F.col("spans")).alias("text"))
    rest = base.where(~hit).select("doc_id", "base", F.col("base").alias("spans"), F.lit(None).cast("string").alias("text"))
    return some.unionByName(rest)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _of(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
