"""Best-fit packing of tokenised documents by a distributed grouping genetic algorithm.

Every document becomes token ids and an end mark; a longer one than a sequence is cut into
full pieces behind a shorter first one. Full pieces are sequences of their own. The others
are dealt into blocks of about ``BLOCK`` pieces, and ``ISLANDS`` islands search each block:
crossover injects whole well-filled sequences of one parent into another, drops the
sequences that hold a piece twice, and best-fits the displaced pieces. After an epoch the
elite of each island moves to the next one of its block. The best packing of a block stays;
sequences that it leaves badly filled are opened, and their pieces go through another round
over fewer blocks.

Blocks have a fixed size, so memory and time of a task do not depend on the input; only the
number of pieces, one figure, is asked for by the driver.

Defined cases: a null text is empty, and packs as its end mark; repeated rows, also those of
one doc_id, are packed each; a null doc_id stays null; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import base64
import functools
import random
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import Scratch, table

SEQUENCE = 2048
END = 0
BLOCK = 3_000  # pieces of a block
ISLANDS = 3
ISLANDS_A_TASK = 4  # about: an island's epoch is shorter than the start of a task
EPOCHS = 2
GENERATIONS = 6
POPULATION = 5
ELITE = 2
WELL_FILLED = 0.99  # of a sequence; less filled ones are opened for the next round
ROUNDS = 3
SPECIAL = "<|endoftext|>"  # fixed value: the vocabulary's special token
SPECIAL_ID = 50256

PIECE_ROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


@functools.lru_cache(maxsize=1)
def _encoding(ranks_file: str):
    """The byte-level vocabulary; its ids are those of the ``tokenizers`` file of the same name (tested)."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(ranks_file), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        ranks_file, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID}
    )


def token_ids(text: str, ranks_file: str = "byte_bpe_50k.tiktoken") -> list[int]:
    encoding = _encoding(ranks_file)
    if SPECIAL in text:
        return encoding.encode(text, allowed_special="all")
    return encoding.encode_ordinary(text)


def token_array(text: str, ranks_file: str = "byte_bpe_50k.tiktoken") -> np.ndarray:
    """The ids of ``token_ids`` and the end mark, without a list on the way (tested to be equal)."""
    allowed = "all" if SPECIAL in text else set()
    ids = _encoding(ranks_file).encode_to_numpy(text, allowed_special=allowed, disallowed_special=())
    return np.append(ids, END).astype("<u4")


def cuts(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; the first of a long document may be shorter."""
    if length <= size:
        return [(0, length)]
    first = length % size or size
    return [(0, first), *((at, size) for at in range(first, length, size))]


def _tokeniser(size: int, ranks_file: str):
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = token_array(text or "", ranks_file)
                for n, (start, length) in enumerate(cuts(len(ids), size)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((doc, n, start, length, crc))
            columns = list(zip(*rows)) or [[] for _ in PIECE_ROW]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECE_ROW)], schema=PIECE_ROW)

    return tokenise


# --- the search in one block: small helpers over lists of sizes ---------------


class Held(list):
    """Pieces of a bin, with the sum of their sizes: asked for many times, added up once."""

    __slots__ = ("filled",)

    def __init__(self, pieces: Iterable[int] = (), filled: int = 0):
        super().__init__(pieces)
        self.filled = filled


def best_fit(sizes: list[int], pieces: list[int], bins: list[Held], capacity: int) -> list[Held]:
    """Put each of ``pieces`` into the open bin that it fills best; ``bins`` and those in it are extended."""
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has r left
    for b, held in enumerate(bins):
        room = capacity - held.filled
        if room in by_room:
            by_room[room].append(b)
        else:
            by_room[room] = [b]
            rooms |= 1 << room
    for i in pieces:
        size = sizes[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms ^= 1 << room
            held = bins[b]
        else:
            room, b, held = capacity, len(bins), Held()
            bins.append(held)
        held.append(i)
        held.filled += size
        room -= size
        if room in by_room:
            by_room[room].append(b)
        else:
            by_room[room] = [b]
            rooms |= 1 << room
    return bins


def fill(sizes: list[int], held: list[int]) -> int:
    return sum(map(sizes.__getitem__, held))


def fitness(sizes: list[int], bins: list[Held], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then unevenly filled ones, which leave room to use."""
    return len(bins), -sum([(held.filled / capacity) ** 2 for held in bins])


def crossover(sizes: list[int], a: list[Held], b: list[Held], capacity: int, rng: random.Random) -> list[Held]:
    """``a`` with a part of the well-filled bins of ``b``."""
    full = sorted(b, key=lambda held: -held.filled)[: max(1, len(b) // 2)]
    injected = rng.sample(full, max(1, len(full) // 2))
    taken = {i for held in injected for i in held}
    kept, displaced = [Held(held, held.filled) for held in injected], []
    for held in a:
        if taken.isdisjoint(held):
            kept.append(Held(held, held.filled))
        else:
            displaced += [i for i in held if i not in taken]
    return best_fit(sizes, sorted(displaced, key=lambda i: -sizes[i]), kept, capacity)


def mutate(sizes: list[int], bins: list[Held], capacity: int, rng: random.Random) -> list[Held]:
    """Open the emptiest bins and some others, and fit their pieces again; the others are taken over from ``bins``."""
    order = sorted(range(len(bins)), key=lambda b: bins[b].filled)
    opened = set(order[:2]) | set(rng.sample(order, min(len(order), 4)))
    displaced = sorted((i for b in opened for i in bins[b]), key=lambda i: -sizes[i] * rng.uniform(0.9, 1.1))
    return best_fit(sizes, displaced, [held for b, held in enumerate(bins) if b not in opened], capacity)


def _bins(sizes: list[int], assigned: list[int]) -> list[Held]:
    out = [Held() for _ in range(max(assigned) + 1)]
    for i, b in enumerate(assigned):
        out[b].append(i)
    for held in out:
        held.filled = fill(sizes, held)
    return out


def _assigned(bins: list[Held], n: int) -> list[int]:
    out = [0] * n
    for b, held in enumerate(bins):
        for i in held:
            out[i] = b
    return out


def evolve(sizes: list[int], population: list[list[int]], capacity: int, seed: int) -> list[list[int]]:
    """An epoch of one island: the elite's assignments of pieces to bins, best first."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    living = [_bins(sizes, assigned) for assigned in population]
    spread = 0.0 if not seed % ISLANDS else 0.2
    while len(living) < POPULATION:
        order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + rng.uniform(-spread, spread)))
        living.append(best_fit(sizes, order, [], capacity))
        spread += 0.1
    # With each packing its fitness, worked out once.
    ranked = sorted(((fitness(sizes, bins, capacity), bins) for bins in living), key=lambda r: r[0])
    for _ in range(GENERATIONS):
        if len(ranked[0][1]) <= least:
            break
        children = []
        for _ in range(POPULATION // 2):
            (_, a), (_, b) = rng.sample(ranked, 2)
            child = mutate(sizes, crossover(sizes, a, b, capacity, rng), capacity, rng)
            children.append((fitness(sizes, child, capacity), child))
        ranked = sorted(ranked + children, key=lambda r: r[0])[:POPULATION]
    return [_assigned(bins, len(sizes)) for _, bins in ranked[:ELITE]]


STATE_DDL = "block long, island int, items array<long>, sizes array<int>, population array<array<int>>"


def _evolver(capacity: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                seed = (r["block"] * EPOCHS + epoch) * ISLANDS + r["island"]
                r["population"] = evolve(r["sizes"], r["population"], capacity, seed)
                yield pa.RecordBatch.from_pylist([r], batch.schema)

    return run


PLACED_DDL = "item long, block long, bin int, offset long, filled long"


def _placer(capacity: int):
    schema = pa.schema([("item", pa.int64()), ("block", pa.int64()), ("bin", pa.int32()), ("offset", pa.int64()), ("filled", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                sizes = r["sizes"]
                for b, held in enumerate(_bins(sizes, r["best"])):
                    at = 0
                    for i in held:
                        rows.append((r["items"][i], r["block"], b, at, held.filled))
                        at += sizes[i]
            columns = list(zip(*rows)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return place


def _search(items: DataFrame, capacity: int, blocks: int, scratch: Scratch, name: str) -> DataFrame:
    """(item, block, bin, offset, filled) of the best packing of each block of ``items`` (item, length)."""
    block = F.pmod(F.xxhash64("item", F.lit(name)), F.lit(blocks)).alias("block")
    grouped = items.select(block, F.struct("item", F.col("length").cast("int").alias("length")).alias("p"))
    grouped = grouped.groupBy("block").agg(F.sort_array(F.collect_list("p")).alias("p"))
    state = grouped.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("p.item").alias("items"),
        F.col("p.length").alias("sizes"),
        F.array().cast("array<array<int>>").alias("population"),
    )
    spread = max(1, min(-(-blocks * ISLANDS // ISLANDS_A_TASK), 100_000))
    for epoch in range(EPOCHS):
        dealt = state.repartition(spread, "block", "island")
        state = scratch.save(dealt.mapInArrow(_evolver(capacity, epoch), STATE_DDL), f"{name}-{epoch}")
        if epoch + 1 < EPOCHS:
            # The first of an island's elite stays, the others move on to the next island.
            guests = state.select(
                "block",
                ((F.col("island") + 1) % ISLANDS).alias("island"),
                F.slice("population", 2, ELITE).alias("guests"),
            )
            own = state.withColumn("own", F.slice("population", 1, 1)).drop("population")
            state = own.join(guests, ["block", "island"]).select(
                "block", "island", "items", "sizes", F.concat("own", "guests").alias("population")
            )
    best = F.col("population")[0]
    used = F.array_max(best)
    chosen = state.groupBy("block").agg(
        F.min_by(F.struct("items", "sizes", best.alias("best")), F.struct(used, "island")).alias("s")
    )
    return chosen.select("block", "s.*").mapInArrow(_placer(capacity), PLACED_DDL)


def pack(docs: DataFrame, size: int = SEQUENCE, ranks_file: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    scratch = Scratch(docs.sparkSession, "packing")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = named.mapInArrow(_tokeniser(size, ranks_file), PIECE_DDL)
    # Numbers are given once, when the table is written.
    pieces = scratch.save(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    open_items = pieces.where(F.col("length") < size).select("item", "length")
    placed = None
    for n in range(ROUNDS):
        count = open_items.count()
        if not count:
            break
        blocks = -(-count // BLOCK)
        found = scratch.save(_search(open_items, size, blocks, scratch, f"round-{n}"), f"placed-{n}")
        last = blocks == 1 or n + 1 == ROUNDS
        stays = found if last else found.where(F.col("filled") >= WELL_FILLED * size)
        sequence = F.lit(n << 58) + F.col("block") * (1 << 16) + F.col("bin")
        stays = stays.select("item", sequence.alias("sequence_id"), "offset")
        placed = stays if placed is None else placed.unionByName(stays)
        if last:
            break
        left = found.where(F.col("filled") < WELL_FILLED * size).select("item").join(pieces, "item")
        open_items = scratch.save(left.select("item", "length"), f"open-{n + 1}")
    full = pieces.where(F.col("length") == size).select(
        "item", (F.lit(ROUNDS << 58) + F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    placed = full if placed is None else placed.unionByName(full)
    return pieces.join(placed, "item").drop("item")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
