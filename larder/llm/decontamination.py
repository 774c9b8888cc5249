"""Benchmark decontamination by greedy string tiling over shared-token seeds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.arrow import map_text, prepare, text_buffers
from larder.llm.ragged import NO_LETTER, gather, ngram_hashes, word_hashes

LEAST_MATCH = 5  # words a tile has at least; a shorter test text must match as a whole
THRESHOLD = 0.5  # share of a test text's words that tiles must cover
BLOCK_BYTES = 16 << 20  # benchmark text that is held at once
_FILTER_BITS = 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _windows(tokens: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows without a marked token, and their Karp-Rabin hashes, from running sums."""
    marked = np.concatenate(([0], np.cumsum(~free)))
    starts = np.flatnonzero(marked[length:] == marked[:-length])
    powers = np.full(len(tokens) + 1, _STEP, np.uint64)
    powers[0] = 1
    back = np.full(len(tokens) + 1, _BACK, np.uint64)
    back[0] = 1
    powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(tokens * powers[:-1], dtype=np.uint64)))
    return starts, (sums[starts + length] - sums[starts]) * back[starts]


def greedy_tiles(test: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token sequences: tiles (start in test, start in text, length).

    Again and again the longest match between tokens not marked yet is marked in both, until no match of
    ``least`` tokens is left. The longest length is found by halving, as a common window of some length implies
    common windows of all shorter ones. Of equally long matches the leftmost in the test goes first, then the
    leftmost in the text.
    """
    free_test, free_text = np.ones(len(test), bool), np.ones(len(text), bool)
    tiles, longest = [], min(len(test), len(text))
    while longest >= least:
        low, high, best = least, longest, 0
        while low <= high:
            middle = (low + high) // 2
            a, b = _windows(test, free_test, middle), _windows(text, free_text, middle)
            if np.isin(a[1], b[1]).any():
                best, low = middle, middle + 1
            else:
                high = middle - 1
        if not best:
            break
        (starts, hashes), (places, others) = _windows(test, free_test, best), _windows(text, free_text, best)
        order = np.argsort(others, kind="stable")
        places, others = places[order], others[order]
        for i, h in zip(starts.tolist(), hashes):
            for j in places[np.searchsorted(others, h):np.searchsorted(others, h, "right")].tolist():
                if not free_test[i:i + best].all():
                    break
                if free_text[j:j + best].all() and (test[i:i + best] == text[j:j + best]).all():
                    free_test[i:i + best] = free_text[j:j + best] = False
                    tiles.append((i, j, best))
        longest = best - 1 if best > least else 0
    return tiles


class Index:
    """Seeds of a block of test texts: hashed n-grams with the test texts that hold them."""

    def __init__(self, keys: list, texts: list[str], least: int):
        words, where = word_hashes(*text_buffers(pa.array(texts, pa.large_string())), NO_LETTER)
        self.keys, self.least = keys, least
        self.tokens = [words[a:b] for a, b in zip(where[:-1], where[1:])]
        grams, begin = ngram_hashes(words, where, least)
        self.lengths = sorted({min(least, len(t)) for t in self.tokens if len(t)})
        seeds, owners = grams, np.repeat(np.arange(len(texts)), np.diff(begin))
        pairs = np.unique(np.stack((seeds, owners.astype(np.uint64))), axis=1) if len(seeds) else np.zeros((2, 0), np.uint64)
        self.seeds, at = np.unique(pairs[0], return_index=True)
        self.owners, self.begin = pairs[1].astype(np.int64), np.append(at, pairs.shape[1])
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.seeds >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, int, list[tuple[int, int, int]]]]:
        """(row, test text, covered words, tiles) of every pair that shares a seed."""
        words, where = word_hashes(*text_buffers(texts), NO_LETTER)
        hits = []  # row, position in the text, seed length, test text
        for length in self.lengths:
            grams, begin = ngram_hashes(words, where, length)
            at = np.flatnonzero(self.filter[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            spot = np.minimum(np.searchsorted(self.seeds, grams[at]), len(self.seeds) - 1)
            found = self.seeds[spot] == grams[at]
            at, spot = at[found], spot[found]
            row = np.searchsorted(begin, at, "right") - 1
            many = self.begin[spot + 1] - self.begin[spot]
            hits.append(np.stack((np.repeat(row, many), np.repeat(at - begin[row], many), np.full(many.sum(), length),
                                  self.owners[gather(self.begin[spot], many)])))
        hits = np.concatenate(hits, axis=1) if hits else np.zeros((4, 0), np.int64)
        hits = hits[:, np.lexsort((hits[1], hits[3], hits[0]))]
        cuts = np.flatnonzero(np.any(hits[[0, 3], 1:] != hits[[0, 3], :-1], axis=0)) + 1 if hits.shape[1] else []
        for part in np.split(hits, cuts, axis=1) if hits.shape[1] else []:
            row, test = int(part[0, 0]), int(part[3, 0])
            tokens, text = self.tokens[test], words[where[row]:where[row + 1]]
            # only words inside seeds can be in a tile; a break keeps the parts of the text apart
            inside = np.zeros(len(text) + 1, np.int64)
            np.add.at(inside, part[1], 1)
            np.add.at(inside, np.minimum(part[1] + part[2], len(text)), -1)
            place = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
            gap = np.concatenate(([0], np.cumsum(np.diff(place) > 1))) + np.arange(len(place))
            kept = np.zeros(gap[-1] + 1, np.uint64)
            back = np.zeros(len(kept), np.int64)
            kept[gap], back[gap] = text[place], place
            tiles = [(i, int(back[j]), n) for i, j, n in greedy_tiles(tokens, kept, min(self.least, len(tokens)))]
            yield row, test, sum(n for _, _, n in tiles), tiles


def benchmark_blocks(benchmark: DataFrame, least: int, item: str, text: str) -> Iterator[Index]:
    """Indexes of the benchmark's texts in blocks of about BLOCK_BYTES, so that each is of bounded size."""
    known = benchmark.filter(F.col(text).isNotNull())
    size = known.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    for block in range(blocks):
        rows = known.filter(F.pmod(F.xxhash64(item, text), F.lit(blocks)) == block).select(item, text).collect()
        if rows:
            yield Index([r[0] for r in rows], [r[1] for r in rows], least)


def contaminated(frame: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: int = LEAST_MATCH,
                 key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """Pairs of a text and a test text whose tiles cover ``threshold`` of the test text's words or more.

    Rows (``key``, ``item``, coverage, n_tiles, tiles); tiles are (test_start, text_start, length) in words, and
    as they may come in any order, reordered passages are caught. Words are runs of letters and digits (all that is
    not ASCII counts as a letter), A-Z in lower case, told apart by a 64-bit hash. The benchmark is a stated query set: it is indexed in blocks of
    bounded size and every block is held against all whole texts, one scan each.

    Null or empty texts on either side match nothing. Null keys and items are kept, repeated rows each give
    their pairs, other columns are left out. An empty table on either side gives no rows.
    """
    spark = prepare(frame.sparkSession)
    kinds = [frame.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()]
    schema = (f"`{key}` {kinds[0]}, `{item}` {kinds[1]}, coverage double, n_tiles long, "
              "tiles array<struct<test_start:int,text_start:int,length:int>>")
    result = None
    for index in benchmark_blocks(benchmark, least, item, text):
        shared = spark.sparkContext.broadcast(index)

        def work(batch: pa.RecordBatch, shared=shared) -> dict | None:
            index = shared.value
            found = [(row, index.keys[test], covered / len(index.tokens[test]), tiles)
                     for row, test, covered, tiles in index.matches(batch.column(text))
                     if covered >= threshold * len(index.tokens[test])]
            if not found:
                return None
            return {key: batch.column(key).take(pa.array([f[0] for f in found])), item: [f[1] for f in found],
                    "coverage": [f[2] for f in found], "n_tiles": [len(f[3]) for f in found],
                    "tiles": [[dict(zip(("test_start", "text_start", "length"), t)) for t in sorted(f[3])] for f in found]}

        pairs = map_text(frame.select(key, text), work, schema, text)
        result = pairs if result is None else result.unionAll(pairs)
    return spark.createDataFrame([], schema) if result is None else result


def keep_uncontaminated(frame: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: int = LEAST_MATCH,
                        item: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of ``frame``, all columns, that no test text is found in."""
    spark = prepare(frame.sparkSession)
    for index in benchmark_blocks(benchmark, least, item, text):
        shared = spark.sparkContext.broadcast(index)

        def work(batch: pa.RecordBatch, shared=shared) -> dict:
            index, keep = shared.value, np.ones(batch.num_rows, bool)
            for row, test, covered, _ in index.matches(batch.column(text)):
                if covered >= threshold * len(index.tokens[test]):
                    keep[row] = False
            return dict(enumerate(batch.filter(pa.array(keep)).columns))

        frame = map_text(frame, work, frame.schema, text)
    return frame
