"""Benchmark decontamination: a prefix-filtered set join with exact containment.

A benchmark window of up to 13 words is a set of word shingles. Containment asks for all of
them, so of the shingles ordered by rarity one, the rarest, is the necessary prefix: only
documents that hold it can hold the window. The join on it is followed by the positional
bounds (the window must fit into the document around the shingle) and by the comparison of
all words.

Native: DataFrame functions only. Document shingles that no benchmark window has are dropped
inside the scan by a bitmap of fixed size (2^20 bits, 128 KB, whatever the benchmark's
size); it lets false ones through but loses none, so it affects the cost only. What is left is
written once, counted for rarity and joined. A hot passage is a hot key of the probe side
only, whose other side has a row per window; adaptive execution splits it.

Defined cases: a null or empty text has no words, is not hit, and as an item has no window;
repeated rows are judged alike (they are told apart by doc_id and text, rows equal in
both give one result); a null doc_id is a document like others; a null item_id has windows,
which hit, but is not listed or counted; empty tables give no rows, or no hits; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import LOWER, UPPER, Scratch, let, lower_ascii, table, text_tag, words

#: Fixed value: what is between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 4
BITS = 20
PER_LONG = 6  # 2^6 bits in a long
CONTAMINATED = 20  # hit words * 20 >= words


def _words(text: Column) -> Column:
    return words(lower_ascii(text), BETWEEN)


def _hash(tokens: Column, start: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(tokens, start + k) for k in range(width)])


def windows_of(items: DataFrame) -> DataFrame:
    """(item_id, window, size): every window of every item, as text, once per item."""
    tokens = items.select("item_id", _words(F.col("text")).alias("w"))
    tokens = tokens.where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(WINDOW))
    starts = F.sequence(F.lit(1), F.size("w") - size + 1)
    texts = F.transform(starts, lambda i: F.array_join(F.slice("w", i, size), " "))
    return tokens.select(
        "item_id", size.alias("size"), F.explode(F.array_distinct(texts)).alias("window")
    )


def _placed(places: Column, width: int) -> Column:
    return F.transform(
        places, lambda i: F.struct(i.alias("at"), _hash(F.col("w"), i, width).alias("shingle"))
    )


def _shingles(windows: DataFrame) -> DataFrame:
    """(window, size, width, at, shingle) of distinct windows."""
    split = windows.select("window", "size").distinct().withColumn("w", F.split("window", " "))
    made = []
    for width in range(1, SHINGLE + 1):
        fits = F.col("size") >= SHINGLE if width == SHINGLE else F.col("size") == width
        places = F.sequence(F.lit(0), F.col("size") - width)
        made.append(
            split.where(fits).select(
                "window", "size", F.lit(width).alias("width"), F.explode(_placed(places, width)).alias("p")
            )
        )
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out.select("window", "size", "width", "p.at", "p.shingle")


def _bitmap(shingles: DataFrame) -> DataFrame:
    """One row with the bitmap of all shingles: always 2^14 longs."""
    bit = F.col("shingle").bitwiseAND((1 << BITS) - 1)
    longs = shingles.select(
        F.shiftright(bit, PER_LONG).alias("slot"),
        F.expr(f"shiftleft(1L, cast(shingle & {(1 << PER_LONG) - 1} as int))").alias("bits"),
    )
    longs = longs.groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    spark = shingles.sparkSession
    slots = spark.range(1 << (BITS - PER_LONG)).withColumnRenamed("id", "slot")
    filled = slots.join(longs, "slot", "left").select("slot", F.coalesce("bits", F.lit(0)).alias("bits"))
    return filled.agg(
        F.transform(F.sort_array(F.collect_list(F.struct("slot", "bits"))), lambda e: e["bits"]).alias("bits")
    )


def _maybe(bits: Column, shingle: Column) -> Column:
    slot = F.shiftright(shingle.bitwiseAND((1 << BITS) - 1), PER_LONG).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), shingle.bitwiseAND((1 << PER_LONG) - 1).cast("int"))
    return F.get(bits, slot).bitwiseAND(one) != 0


def _probes(docs: DataFrame, bitmap: DataFrame, widths: list[int]) -> DataFrame:
    """Each document once, or once for each of its shingles that may be a window's, with the words around it."""
    tokens = docs.select("doc_id", text_tag(F.col("text")).alias("tag"), _words(F.col("text")).alias("w"))
    tokens = tokens.withColumn("bits", bitmap.scalar())
    n = F.size("w")

    def found(width: int) -> Column:
        places = F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))
        pairs = F.transform(
            places,
            lambda i: F.struct(
                F.lit(width).alias("width"), i.alias("i"), _hash(F.col("w"), i, width).alias("shingle")
            ),
        )
        return F.filter(pairs, lambda p: _maybe(F.col("bits"), p["shingle"]))

    every = F.concat(*[found(width) for width in widths]) if len(widths) > 1 else found(widths[0])
    before, reach = WINDOW - SHINGLE, 2 * WINDOW - SHINGLE
    around = F.transform(
        every,
        lambda p: F.struct(
            p["width"].alias("width"),
            p["i"].alias("i"),
            p["shingle"].alias("shingle"),
            F.slice("w", F.greatest(p["i"] - before, F.lit(0)) + 1, reach).alias("around"),
        ),
    )
    rows = tokens.select("doc_id", "tag", n.alias("n_words"), F.explode_outer(around).alias("p"))
    return rows.select("doc_id", "tag", "n_words", "p.width", "p.i", "p.shingle", "p.around")


def _covered(spans: Column) -> Column:
    """Words in the union of (start, size) spans sorted by start."""
    state = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def add(s: Column, e: Column) -> Column:
        end = e["start"] + e["size"]
        return F.struct(
            F.greatest(s["end"], end).alias("end"),
            (s["total"] + F.greatest(F.lit(0), end - F.greatest(s["end"], e["start"]))).alias("total"),
        )

    return F.aggregate(spans, state, add, lambda s: s["total"].cast("long"))


def hits(docs: DataFrame, items: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, tag, n_words), occurrences (doc_id, tag, start, size, window), windows of items."""
    windows = scratch.save(windows_of(items), "windows")
    shingles = scratch.save(_shingles(windows), "shingles")
    # Widths below the full one occur only where an item is that short: four values at most.
    widths = [r["width"] for r in shingles.select("width").distinct().collect()] or [SHINGLE]
    probes = scratch.save(_probes(docs, _bitmap(shingles), sorted(widths)), "probes")
    held = probes.where(F.col("shingle").isNotNull())
    counts = held.groupBy("width", "shingle").agg(F.count("*").alias("n"))
    ranked = shingles.join(counts, ["width", "shingle"], "left")
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("shingle"), F.col("at"))
    prefix = ranked.groupBy("window", "size", "width").agg(F.min(rarity).alias("r"))
    # A window whose rarest shingle no document holds needs no join row.
    prefix = prefix.where("r.n > 0").select("window", "size", "width", "r.at", "r.shingle")
    prefix = scratch.save(prefix, "prefix")
    start = F.col("i") - F.col("at")
    first = F.greatest(F.col("i") - (WINDOW - SHINGLE), F.lit(0))
    inside = F.array_join(F.slice("around", start - first + 1, F.col("size")), " ")
    found = (
        held.join(prefix, ["width", "shingle"])
        .where((start >= 0) & (start + F.col("size") <= F.col("n_words")))
        .where(inside == F.col("window"))
        .select("doc_id", "tag", start.alias("start"), "size", "window")
    )
    return probes, scratch.save(found, "found"), windows


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, tag, n_words, n_hit, items, contaminated) for every distinct (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    probes, found, windows = hits(docs, items, scratch)
    key = ["doc_id", "tag"]
    # A list is bounded by its document's length, or by the benchmark's items.
    cover = found.groupBy(*key).agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    cover = cover.select(*key, _covered(F.sort_array("spans")).alias("n_hit"))
    named = (
        found.select(*key, "window").distinct().join(windows.where("item_id IS NOT NULL"), "window")
        .groupBy(*key)
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    every = probes.groupBy(*key).agg(F.max("n_words").cast("long").alias("n_words"))
    # Null-safe: a null doc_id is a key as well.
    cover = cover.withColumnsRenamed({"doc_id": "c_id", "tag": "c_tag"})
    named = named.withColumnsRenamed({"doc_id": "i_id", "tag": "i_tag"})
    joined = every.join(
        cover, F.expr("doc_id <=> c_id AND tag = c_tag"), "left"
    ).join(named, F.expr("doc_id <=> i_id AND tag = i_tag"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "tag",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (CONTAMINATED * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_SPLIT = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}'), lambda x: x <> '')"

ORACLE = {
    "op9_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SPLIT} AS w FROM documents),
b AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, m, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') AS win
       FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
             FROM (SELECT *, least(len(w), {WINDOW}) AS m FROM b WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT r, m, i, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') AS win
       FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes)),
h AS (SELECT r, i, m, item_id FROM dw JOIN bw USING (m, win)),
c AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + m)) AS k FROM (SELECT DISTINCT r, i, m FROM h)) GROUP BY r),
n AS (SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(n.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AND {CONTAMINATED} * coalesce(c.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN n USING (r)
"""
}
