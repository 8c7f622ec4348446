"""Secret scans: rules, and a character convolutional network over every candidate.

Base rules find assigned secrets, access keys and long hexadecimal strings. Candidates are
all long strings of key characters with a digit. The network reads a candidate with the
characters around it; it is trained on labelled findings (a candidate is positive where a base
rule found it), from which half of the contexts are taken away, so that it has to know secrets
by their own characters as well. Scores are calibrated on a held-out part, and the threshold is
the highest that still reaches the wanted recall there.

All distinct findings take part, wherever they lie. They are dealt by hash into shards of about
``SHARD``; each shard trains from the shared weights, and these become the mean of the shards',
weighted by findings, ``ROUNDS`` times. Weights are summed as integers, and calibration and
threshold come from counts of all held-out scores on a grid of 1/``GRID``, so the model does not
depend on the number of executors. A task holds one shard, the driver the model and the grid.

Defined cases: a null text is empty; repeated rows are scanned alike; without findings of both
labels (as in an empty table) there is no network, and the rules' findings are all; other
columns are not read by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import Scratch, table

# The contract's kinds, in order, and the network's after them.
KINDS = ("assign", "access", "hex", "network")
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")

SHARD = 4_000  # findings that are trained on together
ROUNDS = 3  # at most, of training apart and taking the mean
WHOLE = 10**9  # weights are added as integers of this many to one
GRID, FARTHEST = 256, 40  # places of a logit between whole numbers, and its largest size there
RECALL = 0.95  # to reach on the held-out part
HELD_OUT = 30  # in a hundred
BEFORE, INSIDE, AFTER = 24, 48, 8
WIDTH = BEFORE + INSIDE + AFTER
OTHER, PAD = 95, 96  # characters beside the printable ones, and no character
EMBEDDING, FILTERS, REACH = 8, 16, 5
EPOCHS, BATCH, RATE = 12, 128, 0.01
MASK = "[SECRET]"


class Span(NamedTuple):
    start: int
    kind: int  # place in KINDS
    end: int


def base_spans(text: str) -> list[Span]:
    spans = [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if any(c.isdigit() for c in m[0])]


def view(text: str, start: int, end: int) -> str:
    """The characters of a candidate and around it, in fixed places; NUL where there is none."""
    before = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0")
    inside = text[start : min(end, start + INSIDE)].ljust(INSIDE, "\0")
    return before + inside + text[end : end + AFTER].ljust(AFTER, "\0")


def encode(views: list[str]) -> np.ndarray:
    codes = np.array([list(map(ord, v)) for v in views], np.int64).reshape(len(views), WIDTH)
    printable = (codes >= 32) & (codes < 127)
    return np.where(printable, codes - 32, np.where(codes == 0, PAD, OTHER))


#: Whether a place holds the candidate or what is around it.
WITHIN = np.concatenate([np.zeros(BEFORE), np.ones(INSIDE), np.zeros(AFTER)]).astype(np.float32)


class Network(NamedTuple):
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray
    scale: float = 1.0  # calibration
    shift: float = 0.0
    threshold: float = 1.1  # nothing passes before calibration

    def _patches(self, codes: np.ndarray) -> np.ndarray:
        flags = np.broadcast_to(WITHIN[None, :, None], (*codes.shape, 1))
        signal = np.concatenate([self.embedding[codes], flags], axis=2)
        seen = np.lib.stride_tricks.sliding_window_view(signal, REACH, axis=1)
        return seen.reshape(len(codes), WIDTH - REACH + 1, -1)

    def forward(self, codes: np.ndarray):
        patches = self._patches(codes)
        found = patches @ self.filters + self.bias
        at = found.argmax(axis=1)
        peak = np.take_along_axis(found, at[:, None, :], axis=1)[:, 0, :]
        hidden = np.maximum(peak, 0)
        return hidden @ self.dense + self.offset, hidden, at, patches

    def probability(self, codes: np.ndarray) -> np.ndarray:
        parts = [self.forward(codes[i : i + 1024])[0] for i in range(0, len(codes), 1024)]
        logits = np.concatenate(parts) if parts else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -40, 40)))


def _gradients(net: Network, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray | float = 1.0) -> list[np.ndarray]:
    logits, hidden, at, patches = net.forward(codes)
    error = ((1 / (1 + np.exp(-np.clip(logits, -40, 40)))) - labels) * weights / len(labels)
    through = error[:, None] * net.dense * (hidden > 0)
    rows = np.arange(len(codes))[:, None]
    seen = patches[rows, at]  # (batch, filters, channels * reach)
    filters = np.einsum("nf,nfc->cf", through, seen)
    back = (through[:, :, None] * net.filters.T).reshape(len(codes), FILTERS, EMBEDDING + 1, REACH)
    embedding = np.zeros_like(net.embedding)
    for k in range(REACH):
        np.add.at(embedding, codes[rows, at + k], back[:, :, :EMBEDDING, k])
    return [embedding, filters, through.sum(0), hidden.T @ error, error.sum(keepdims=True)]


CHANNELS = (EMBEDDING + 1) * REACH
SHAPES = ((PAD + 1, EMBEDDING), (CHANNELS, FILTERS), (FILTERS,), (FILTERS,), (1,))


def start(seed: int = 7) -> list[np.ndarray]:
    """The weights that training begins with."""
    rng = np.random.default_rng(seed)
    spread = (0.3, 1 / np.sqrt(CHANNELS), 0, 0.3, 0)
    return [rng.normal(0, d, shape).astype(np.float32) for d, shape in zip(spread, SHAPES)]


def flat(weights: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights])


def shaped(values: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum([int(np.prod(shape)) for shape in SHAPES])[:-1]
    return [part.reshape(shape).astype(np.float32) for part, shape in zip(np.split(values, ends), SHAPES)]


def fit(
    codes: np.ndarray, labels: np.ndarray, begin: list[np.ndarray], epochs: int, balance: dict[int, float], seed: int = 7
) -> list[np.ndarray]:
    """Weights by Adam from ``begin``; ``balance`` is the weight of a finding of each label."""
    rng = np.random.default_rng(seed)
    weights = list(begin)
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for i in range(0, len(order), BATCH):
            step += 1
            part = order[i : i + BATCH]
            mine = np.where(labels[part] == 1, balance[1], balance[0])
            for n, g in enumerate(_gradients(Network(*weights), codes[part], labels[part], mine)):
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                up = (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                weights[n] = (weights[n] - RATE * up).astype(np.float32)
    return weights


def calibrate(net: Network, counts: dict[tuple[int, int], int], recall: float = RECALL) -> Network:
    """Scale and shift of the logits by maximum likelihood, and the recall-constrained threshold.

    ``counts`` has the number of held-out findings by label and place of their logit on the grid.
    """
    labels, places = np.array(sorted(counts), np.int64).T
    n = np.array([counts[key] for key in sorted(counts)], float)
    logits = places / GRID
    a, b = 1.0, 0.0
    positives, negatives = n[labels == 1].sum(), n[labels == 0].sum()
    # Targets short of 0 and 1, so that separable data do not send the scale to infinity.
    target = np.where(labels == 1, (positives + 1) / (positives + 2), 1 / (negatives + 2))
    for _ in range(500):
        error = (1 / (1 + np.exp(-np.clip(a * logits + b, -40, 40))) - target) * n / n.sum()
        a -= 0.05 * float((error * logits).sum())
        b -= 0.05 * float(error.sum())
    below = np.cumsum(n[labels == 1])
    lowest = logits[labels == 1][np.searchsorted(below, np.floor((1 - recall) * positives), side="right")]
    net = net._replace(scale=a, shift=b)
    return net._replace(threshold=float(1 / (1 + np.exp(-np.clip(a * lowest + b, -40, 40)))))


def _overlaps(start: int, end: int, spans: list[Span]) -> bool:
    return any(s.start < end and start < s.end for s in spans)


def all_spans(texts: list[str], net: Network | None) -> list[tuple[list[Span], list[Span]]]:
    """(base, all) spans of each text."""
    based = [base_spans(t) for t in texts]
    added: list[list[Span]] = [[] for _ in texts]
    if net is not None:
        asked = [
            (n, start, end)
            for n, text in enumerate(texts)
            for start, end in candidates(text)
            if not _overlaps(start, end, based[n])
        ]
        for i in range(0, len(asked), 4096):
            part = asked[i : i + 4096]
            sure = net.probability(encode([view(texts[n], start, end) for n, start, end in part]))
            for (n, start, end), p in zip(part, sure):
                if p >= net.threshold:
                    added[n].append(Span(start, 3, end))
    return [(base, sorted(base + more)) for base, more in zip(based, added)]


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("view", pa.string()), ("label", pa.int32())])
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            spans = base_spans(text or "")
            for start, end in candidates(text or ""):
                rows.append((doc, start, view(text, start, end), int(_overlaps(start, end, spans))))
        columns = list(zip(*rows)) or [[] for _ in schema]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _trainer(begin: list[np.ndarray], epochs: int, balance: dict[int, float], seed: int):
    def train(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["h", "view"])
        codes, labels = encode(list(shard["view"])), shard["label"].to_numpy(np.float32)
        bare = codes.copy()
        bare[:, :BEFORE] = PAD
        bare[:, BEFORE + INSIDE :] = PAD
        found = fit(np.concatenate([codes, bare]), np.concatenate([labels] * 2), begin, epochs, balance, seed)
        whole = np.round(flat(found).astype(float) * WHOLE).astype(np.int64)
        return pd.DataFrame({"place": np.arange(len(whole)), "value": whole, "n": np.int64(len(shard))})

    return train


def _trained(findings: DataFrame, rounds: int, balance: dict[int, float]) -> list[np.ndarray]:
    """Weights from all findings (shard, h, view, label)."""
    weights = start()
    for n in range(rounds):
        train = _trainer(weights, EPOCHS // rounds, balance, 7 + n)
        made = findings.groupBy("shard").applyInPandas(train, "place long, value long, n long")
        total = F.sum(F.col("value").cast("decimal(20,0)") * F.col("n").cast("decimal(18,0)"))
        means = made.groupBy("place").agg(total.cast("string").alias("total"), F.sum("n").alias("n"))
        at = {r["place"]: int(r["total"]) / r["n"] / WHOLE for r in means.collect()}
        weights = shaped(np.array([at[place] for place in sorted(at)]))
    return weights


def _places(net: Network):
    schema = pa.schema([("label", pa.int32()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = encode(batch.column(0).to_pylist())
            logits = [net.forward(codes[i : i + 1024])[0] for i in range(0, len(codes), 1024)] or [np.zeros(0)]
            places = np.floor(np.clip(np.concatenate(logits), -FARTHEST, FARTHEST) * GRID).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(places)], schema=schema)

    return run


def learn(docs: DataFrame, shard: int = SHARD) -> Network | None:
    """A calibrated network from all distinct findings, or None without enough of both labels.

    Where fewer than two of a label would be held out, all are both shown and held out.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = named.mapInArrow(_labelled, "doc_id long, start long, view string, label int")
    hashed = found.select("view", "label").distinct().withColumn("h", F.xxhash64("view"))
    held = F.pmod(F.xxhash64("h", F.lit("held")), F.lit(100)) < HELD_OUT
    findings = scratch.save(hashed.withColumn("held", held), "findings")
    try:
        tally = findings.groupBy("label").agg(F.count("*").alias("n"), F.count_if("held").alias("held")).collect()
        n, out = {r["label"]: r["n"] for r in tally}, {r["label"]: r["held"] for r in tally}
        if sum(n.values()) < 20 or min(n.get(0, 0), n.get(1, 0)) < 5:
            return None
        apart = all(2 <= out[label] <= n[label] - 2 for label in (0, 1))
        shown, asked = (findings.where("NOT held"), findings.where("held")) if apart else (findings, findings)
        shards = -(-sum(n.values()) // shard)
        balance = {label: sum(n.values()) / (2 * n[label]) for label in (0, 1)}
        dealt = shown.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))
        net = Network(*_trained(dealt, min(ROUNDS, shards), balance))
        places = asked.select("view", "label").mapInArrow(_places(net), "label int, place long")
        counts = places.groupBy("label", "place").count().collect()
        return calibrate(net, {(r["label"], r["place"]): r["count"] for r in counts})
    finally:
        scratch.drop("findings")


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
SPANS_DDL = "array<struct<start: int, end: int, kind: string>>"


def _as_rows(spans: list[Span]) -> list[dict]:
    return [{"start": s.start, "end": s.end, "kind": KINDS[s.kind]} for s in spans]


def scan(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, base, spans) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(SPAN)), ("spans", pa.list_(SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = all_spans(texts, net)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([_as_rows(f[n]) for f in found], pa.list_(SPAN)) for n in (0, 1))],
                schema=schema,
            )

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return named.mapInArrow(run, f"doc_id long, base {SPANS_DDL}, spans {SPANS_DDL}")


def masked(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for s in spans:
        if s.end > at:
            if s.start >= at:
                out += [text[at : s.start], MASK]
            at = s.end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with every finding in ``text`` masked; texts without one stay as they are.

    A count ``n_chars`` changes with its text.
    """
    names = docs.columns
    at = names.index("text")
    count = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = all_spans([t or "" for t in texts], net)
            clean = [masked(t, every) if every else t for t, (_, every) in zip(texts, found)]
            columns = list(batch.columns)
            columns[at] = pa.array(clean, batch.schema.field(at).type)
            if count is not None:
                longer = [len(a or "") - len(b or "") for a, b in zip(clean, texts)]
                sizes = [None if n is None else n + d for n, d in zip(columns[count].to_pylist(), longer)]
                columns[count] = pa.array(sizes, batch.schema.field(count).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, learn(docs))

    def counted(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans: str):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    return found.select(
        "doc_id",
        *[counted(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )
