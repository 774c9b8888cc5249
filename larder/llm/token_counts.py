"""Token counts of a byte-level BPE by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from larder.llm.arrow import map_text, text_buffers
from larder.llm.ragged import gather, span_hashes

CACHE_LIMIT = 400_000  # distinct pre-tokens whose counts a task remembers; it starts anew beyond that
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)


def _classes() -> np.ndarray:
    """Class of every code point, by the property names of the split pattern."""
    table = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\p{White_Space}")):
        table[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return table


class ByteBpe:
    """A byte-level BPE read from a tokenizer file, with the counts of pre-tokens seen before."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE without normaliser and prefix space is expected")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        vocabulary = model["vocab"]
        # Bytes are written as printable characters: those that print stand for themselves, the rest follow from U+0100.
        printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in printing}
        shown |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.of_byte = np.array([vocabulary[shown[b]] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.classes = _classes()
        self.counts: dict[int, int] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; the number of merges where there is none."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], len(self.keys))

    def pretokens(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions at which a pre-token begins, ascending.

        The pattern is: a contraction ('s 't 're 've 'm 'll 'd), or a run of letters, of numbers or of other
        characters with one space before it, or white space up to the last one before a non-space.
        """
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kind = self.classes[points]
        first = np.zeros(len(points) + 1, bool)  # the first character of a text
        first[np.searchsorted(heads, offsets)] = True
        text_end = first[1:]
        first = first[:-1]
        space = kind == _SPACE
        start = np.ones(len(points), bool)
        start[1:] = kind[1:] != kind[:-1]
        start |= first
        # White space gives its last character up before a non-space; a plain space then leads the run after it.
        last = space.copy()
        last[:-1] &= ~space[1:]
        last &= ~text_end
        start |= last
        leads = np.flatnonzero(last & (points == 32)) + 1
        start[leads] = False
        # Contractions count where a match can begin: not inside a run of other characters, not after a leading space.
        quote = np.flatnonzero((points == 39) & start)
        if len(quote):
            padded = np.concatenate((np.where(first, 0, points), [0, 0])).astype(np.uint32)
            one, two = padded[quote + 1], padded[quote + 2]
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = np.zeros(len(quote), bool)
            for a, b in ("re", "ve", "ll"):
                long |= (one == ord(a)) & (two == ord(b))
            for hit, size in ((short, 2), (long & ~short, 3)):
                at = quote[hit]
                start[at + 1] = False
                if size == 3:
                    start[at + 2] = False
                after = at + size
                start[after[after < len(points)]] = True
        # A space that leads the rest of a word after a contraction cannot exist, so starts need no second pass.
        return heads[start]

    def merge(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Symbols left of each byte span after all merges.

        One round merges, in every sequence at the same time, all occurrences of the sequence's lowest-ranked
        pair; finished sequences leave the arrays.
        """
        lengths = ends - starts
        result = lengths.copy()
        symbols = self.of_byte[data[gather(starts, lengths)]]
        rows = np.arange(len(starts))
        none = len(self.keys)
        rank = np.full(len(symbols), none)
        begin = np.cumsum(lengths) - lengths
        rank[:-1] = self.rank(symbols[:-1], symbols[1:])
        rank[begin + lengths - 1] = none
        while len(rows):
            lowest = np.minimum.reduceat(rank, begin)
            live = lowest < none
            result[rows[~live]] = lengths[~live]
            if not live.all():
                keep = np.repeat(live, lengths)
                symbols, rank = symbols[keep], rank[keep]
                rows, lengths, lowest = rows[live], lengths[live], lowest[live]
                begin = np.cumsum(lengths) - lengths
                if not len(rows):
                    break
            row = np.repeat(np.arange(len(rows)), lengths)
            hit = rank == lowest[row]
            at = np.flatnonzero(hit)
            # In a run of neighbouring hits (a a a) only every other one merges.
            new_run = np.ones(len(at), bool)
            new_run[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
            in_run = np.arange(len(at)) - np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[in_run % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            gone = np.zeros(len(symbols), bool)
            gone[at + 1] = True
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[np.maximum(at - 1, 0)] = True
            lengths = lengths - np.bincount(row[at], minlength=len(rows))
            keep = ~gone
            symbols, rank, changed = symbols[keep], rank[keep], changed[keep]
            begin = np.cumsum(lengths) - lengths
            again = np.flatnonzero(changed)
            final = np.zeros(len(symbols), bool)
            final[begin + lengths - 1] = True
            rank[again] = self.rank(symbols[again], symbols[np.minimum(again + 1, len(symbols) - 1)])
            rank[final] = none
        return result

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text; ``offsets`` cut ``data`` into texts without special strings."""
        if not len(data):
            return np.zeros(len(offsets) - 1, np.int64)
        starts = self.pretokens(data, offsets)
        ends = np.append(starts[1:], len(data))
        keys, at, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.counts) > CACHE_LIMIT:
            self.counts.clear()
        known = [self.counts.get(k, -1) for k in keys.tolist()]
        sizes = np.array(known, np.int64)
        new = np.flatnonzero(sizes < 0)
        if len(new):
            sizes[new] = self.merge(data, starts[at[new]], ends[at[new]])
            self.counts.update(zip(keys[new].tolist(), sizes[new].tolist()))
        sums = np.concatenate(([0], np.cumsum(sizes[inverse])))
        return np.diff(sums[np.searchsorted(starts, offsets)])


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> ByteBpe:
    """The tokenizer of this worker process, which goes on from task to task with what it remembers."""
    return ByteBpe(path)


def count_tokens(frame: DataFrame, tokenizer_path: str, limit: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    Counts are those of the tokenizer's own library without begin and end tokens; a special string inside a
    text is one token. A null or empty text has 0 bytes and 0 tokens, a null key stays null, repeated rows each
    give a row, and other columns are left out. Texts may be of any length: a task holds the pre-tokens of
    about 2 MB of text, or of one longer text. Pre-tokens are recognised by a 64-bit hash.

    ``tokenizer_path`` is read once per worker process and must be at the same place on all machines.
    """
    def work(batch: pa.RecordBatch, bpe: ByteBpe) -> dict:
        texts = batch.column(text).fill_null("")
        data, offsets = text_buffers(texts)
        special = np.zeros(len(texts), np.int64)
        n_bytes = np.diff(offsets)
        found = pc.match_substring_regex(texts, "|".join(map(regex.escape, bpe.specials))) if bpe.specials else None
        if found is not None and pc.any(found).as_py():
            cut = regex.compile("|".join(map(regex.escape, bpe.specials)))
            pieces = [cut.split(t) for t in texts.to_pylist()]
            special = np.array([len(p) - 1 for p in pieces])
            data, offsets = text_buffers(pa.array([x for p in pieces for x in p], pa.large_string()))
            counts = bpe.count(data, offsets)
            sums = np.concatenate(([0], np.cumsum(counts)))
            tokens = np.diff(sums[np.concatenate(([0], np.cumsum(special + 1)))]) + special
        else:
            tokens = bpe.count(data, offsets)
        return {key: batch.column(key), "n_bytes": n_bytes, "n_tokens": tokens, "over_limit": tokens > limit}

    kind = frame.schema[key].dataType.simpleString()
    return map_text(frame.select(key, text), work, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean",
                    text, setup=lambda: _tokenizer(tokenizer_path))
