"""Ragged numpy arrays: words and word n-grams of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
NO_LETTER = np.ones(256, bool)  # breaks words at any ASCII character that is no letter or digit
NO_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``data``, bytes or code points, by prefix sums (spans in ascending order)."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):  # groups of spans within CHUNK bytes, or one longer span
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, low + CHUNK, "right")))
        high = int(ends[last - 1])
        up, down = _power_tables(max(CHUNK, high - low) + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        symbols = _BYTE[data[low:high]] if data.dtype == np.uint8 else mix(data[low:high].astype(np.uint64) + np.uint64(1))
        np.cumsum(symbols * up[:high - low], out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without ``breaks``, ASCII white space): their starts, ends, and for each text where they begin."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~breaks[data]
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    tail = inside.copy()
    tail[:-1] &= ~inside[1:]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    head[cuts] = inside[cuts]
    tail[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words with A-Z in lower case, and for each text where its words begin."""
    starts, ends, where = word_spans(data, offsets, breaks)
    return span_hashes(_LOWER[data], starts, ends), where


def ngram_hashes(words: np.ndarray, where: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's word n-grams in text order; a shorter text gives its whole sequence as one.

    Returns the hashes and for each text where its n-grams begin.
    """
    counts = np.diff(where)
    grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    begin = np.concatenate(([0], np.cumsum(grams)))
    first = np.repeat(where[:-1] - begin[:-1], grams) + np.arange(begin[-1])
    size = np.repeat(np.minimum(counts, n), grams)
    out = np.zeros(len(first), np.uint64)
    padded = np.concatenate((words, np.zeros(n, np.uint64)))
    for k in range(n):
        out = np.where(k < size, out * _BASE + padded[first + k], out)  # the same for a short text at any n
    return mix(out + size.astype(np.uint64)), begin


def distinct_per_row(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row of a ragged array."""
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[keep], np.searchsorted(row[keep], np.arange(len(begin)))


def gather(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs ``begin[i] .. begin[i] + lengths[i]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - (ends - lengths), lengths) + np.arange(total)
