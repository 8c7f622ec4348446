"""Anchors: sampled places that every repeat of a given length must share.

A text is a row of symbols (bytes or words). Of the ``k``-grams inside each window of
``window`` symbols the one of least hash is the window's anchor. Equal windows have equal
anchors, so windows need comparing only with those of the same anchor; and neighbouring
windows mostly share theirs, so a text has about ``2 / (window - k + 2)`` anchors a symbol.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, times: int) -> np.uint64:
    return np.uint64(pow(int(base), times, 1 << 64))


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` symbols from every place on, by doubling."""
    out, length, done = None, 0, 0
    part, size = symbols, 1
    while True:
        if k & size:
            if out is None:
                out, length = part, size
            else:  # ``part`` covers the ``size`` symbols after those in ``out``
                n = len(symbols) - length - size + 1
                out = out[:n] * _power(_BASE, size) + part[length : length + n]
                length += size
        done += k & size
        if done == k:
            return _mix(out)
        n = len(part) - size
        part = part[:n] * _power(_BASE, size) + part[size : size + n]
        size *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _again(grams: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """Anchors that occur twice near each other, so that windows of one run may be equal."""
    pad = np.zeros(width - 1, np.uint64)
    # A gram is the anchor of a window around it if it is as small as the largest of their minima.
    largest = ~sliding_min(~np.concatenate((pad, least, pad)), width)
    places = np.flatnonzero(grams == largest)
    values = grams[places]
    return values[1:][values[1:] == values[:-1]]


class Runs(NamedTuple):
    anchor: np.ndarray
    first: np.ndarray  # first window
    n: np.ndarray  # windows
    again: np.ndarray  # whether windows of one run may be equal; only if asked for


def anchors(symbols: np.ndarray, window: int, k: int, inside: bool = False) -> Runs:
    """Runs of windows with one anchor.

    A run holds at most ``window`` windows; longer ones, of periodic texts, are cut.
    """
    if len(symbols) < window:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.astype(bool))
    width = window - k + 1
    grams = gram_hashes(symbols, k)
    least = sliding_min(grams, width)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    counts = np.diff(np.append(first, len(least)))
    if counts.max() > window:
        pieces = -(-counts // window)
        run = np.repeat(np.arange(len(first)), pieces)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        counts = np.minimum(window, counts[run] - nth * window)
        first = first[run] + nth * window
    anchor = least[first]
    twice = _again(grams, least, width) if inside else anchor[:0]
    again = np.isin(anchor, twice) if len(twice) else np.zeros(len(anchor), bool)
    return Runs(anchor.astype(np.int64), first.astype(np.int64), counts.astype(np.int64), again)


def byte_symbols(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)


def split_words(text: bytes) -> list[bytes]:
    """Words between the white space of the contract; other control bytes belong to words."""
    return text.split()


def word_symbols(tokens: list[bytes]) -> np.ndarray:
    """One 64-bit hash a word, computed over all bytes of the text at once."""
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = np.frombuffer(b"".join(tokens), np.uint8).astype(np.uint64) + np.uint64(1)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.cumsum(lengths) - lengths
    within = np.arange(len(joined)) - np.repeat(starts, lengths)
    return _mix(np.add.reduceat(_mix(joined + within.astype(np.uint64) * _BASE), starts))
