"""Importance resampling towards a target distribution, with hashed n-gram counts made by Arrow kernels."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.arrow import map_text, prepare, slices, with_field
from larder.operators.ranking import global_row_number
from larder.session import settle

BUCKETS = 10_000
ORDER = 3  # longest run of words that is a feature
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MIN_WORDS, PERCENT = 20, 5


class Shift:
    """What a CRC-32 becomes when bytes follow: crc(a + b) is the shift of crc(a) by len(b), XOR crc(b).

    The shift by a length is linear in the bits of the CRC, so it is looked up byte by byte.
    """

    def __init__(self):
        self.rows: dict[int, int] = {}
        self.tables = np.zeros((0, 4, 256), np.uint32)

    def add(self, lengths: np.ndarray) -> None:
        new = [n for n in lengths.tolist() if n not in self.rows]
        made = np.zeros((len(new), 4, 256), np.uint32)
        for row, n in enumerate(new):
            self.rows[n] = len(self.rows)
            zeros = bytes(n)
            still = zlib.crc32(zeros)
            for bit in range(32):
                place, inner = divmod(bit, 8)
                made[row, place, 1 << inner:2 << inner] = made[row, place, :1 << inner] ^ np.uint32(zlib.crc32(zeros, 1 << bit) ^ still)
        self.tables = np.concatenate((self.tables, made))

    def __call__(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        distinct, which = np.unique(lengths, return_inverse=True)
        if len(self.rows) > 4096:  # lengths seen before; a few are used again and again
            self.__init__()
        self.add(distinct)
        row = np.array([self.rows[n] for n in distinct.tolist()], np.int64)[which]
        out = np.zeros(len(crcs), np.uint32)
        for place in range(4):
            out ^= self.tables[row, place, (crcs >> np.uint32(8 * place)) & np.uint32(255)]
        return out


class Features:
    """Buckets of the word runs of a batch of texts."""

    def __init__(self, order: int = ORDER, buckets: int = BUCKETS):
        self.order, self.buckets, self.shift = order, buckets, Shift()

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Words per text, and for each run length: the text of every run, its place among the distinct runs, and
        the buckets of these."""
        # lowered before the cast: the cast of a slice keeps offsets that ascii_lower does not subtract
        words = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")).cast(pa.large_string()), SEPARATORS)
        flat, owner = pc.list_flatten(words), pc.list_parent_indices(words)
        filled = pc.greater(pc.binary_length(flat), 0)
        coded, owner = flat.filter(filled).dictionary_encode(), owner.filter(filled).to_numpy(zero_copy_only=False)
        vocabulary = coded.dictionary.cast(pa.large_binary())
        crcs = np.array([zlib.crc32(w) for w in vocabulary.to_pylist()], np.uint32)
        lengths = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        runs, run, run_crcs = [(owner, word, crcs % np.uint64(self.buckets))], word, crcs
        blank = np.uint32(zlib.crc32(b" "))
        for n in range(2, self.order + 1):
            inside = owner[n - 1:] == owner[:len(owner) - n + 1]  # the run does not cross into the next text
            first, last = run[:max(0, len(owner) - n + 1)], word[n - 1:]
            pairs = pa.array(first * max(1, len(crcs)) + last).dictionary_encode()
            pair = pairs.dictionary.to_numpy(zero_copy_only=False)
            head, tail = np.divmod(pair, max(1, len(crcs)))
            spaced = self.shift(run_crcs[head], np.ones(len(head), np.int64)) ^ blank
            run_crcs = self.shift(spaced, lengths[tail]) ^ crcs[tail]
            run = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            runs.append((owner[:max(0, len(owner) - n + 1)][inside], run[inside], run_crcs % np.uint64(self.buckets)))
        return np.bincount(owner, minlength=len(texts)), runs


def bucket_counts(frame: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket.

    A task sums up its own texts and gives one row per bucket met; Spark adds these up, and the driver gets one
    number per bucket, however large the table.
    """
    prepare(frame.sparkSession)

    def count(batches):
        features, total = Features(order, buckets), np.zeros(buckets, np.int64)
        for part in slices(batches, "text"):
            for _, run, bucket in features(part.column("text"))[1]:
                total += np.bincount(bucket, np.bincount(run, minlength=len(bucket)), buckets).astype(np.int64)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    parts = frame.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln of its smoothed share of the target over that of the raw texts)."""
    s, t, buckets = raw.astype(float), target.astype(float), len(raw)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(frame: DataFrame, gain: np.ndarray, text: str = "text", order: int = ORDER) -> DataFrame:
    """``frame`` without ``text`` and with n_words, n_features and weight, the sum of the gains of a text's features.

    A null or empty text has no features and weight 0. Columns of these names are replaced.
    """
    added = {"n_words": "long", "n_features": "long", "weight": "long"}
    others = [c for c in frame.columns if c != text and c not in added]
    schema = T.StructType([frame.schema[c] for c in others])
    for name, kind in added.items():
        schema = with_field(schema, name, kind)
    shared = frame.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def work(batch: pa.RecordBatch, features: Features) -> dict:
        n_words, runs = features(batch.column(text))
        n_features, weight = np.zeros((2, batch.num_rows), np.int64)
        for owner, run, bucket in runs:
            of_run = shared.value.take(bucket.astype(np.int64)).take(run)
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))  # runs lie in the order of their texts
            total = np.concatenate(([0], np.cumsum(of_run)))
            n_features += np.diff(ends)
            weight += np.diff(total[ends])
        return {**{c: batch.column(c) for c in others}, "n_words": n_words, "n_features": n_features, "weight": weight}

    return map_text(frame.select(*others, text), work, schema, text, lambda: Features(order, len(shared.value)))


def resample(frame: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             seed: int = 42, min_words: int = MIN_WORDS, percent: int = PERCENT, order: int = ORDER,
             buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``frame``: its columns but ``text``, and n_words, n_features, weight, score and rank.

    Features are all runs of up to ``order`` words, counted in CRC-32 buckets over all texts. A row's weight is how
    much likelier its features are among the target's texts; Gumbel noise, keyed by ``seed`` and ``key``, is added,
    and of the rows with at least ``min_words`` words the ``percent`` percent with the highest scores are drawn,
    which samples without replacement in proportion to the weights. ``rank`` numbers the drawn ones, null elsewhere.

    Null and empty texts have weight 0 and are never drawn (if ``min_words`` is 1 or more); a null key counts as an
    empty one in the noise and comes last among ties; repeated rows are rows of their own. Texts may be of any
    length. Empty tables, of either kind, count nothing. Columns named like the results are replaced.
    """
    gain = gains(bucket_counts(frame, text, order, buckets), bucket_counts(target, target_text, order, buckets))
    rest = frame.drop("n_words", "n_features", "weight", "score", "rank")
    weighed = weigh(rest, gain, text, order)
    drawn_hash = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    uniform = (F.conv(drawn_hash, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(-1000 * F.log(-F.log(uniform)))
    scored = settle(weighed.withColumn("score", (F.col("weight") + noise).cast("long")), "scores")
    fit = F.col("n_words") >= min_words
    n_drawn = scored.filter(fit).count() * percent // 100
    order_by = [F.desc("score"), F.asc_nulls_last(key), "n_features", "weight"]
    ranked = global_row_number(scored.filter(fit), order_by, "rank")
    chosen = ranked.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    return chosen.unionByName(scored.filter(~fit).withColumn("rank", F.lit(None).cast("long")))
