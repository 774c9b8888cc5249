"""Importance resampling against a plain version in Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from larder.llm import resampling

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(plain_features(text)[1])
    for text in target:
        t.update(plain_features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    out, fit = [], []
    for key, text in rows:
        words, features = plain_features(text)
        weight = sum(gain(b) for b in features)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(features), weight, score, None])
        if len(words) >= 20:
            fit.append(out[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(fit[:5 * len(fit) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, out), key=repr)


def corpus():
    rng = random.Random(8)
    words = ["The", "of", "ÄPFEL", "äpfel", "x1", "B2b", "日本", "e", "it's", "A-B", "q\x00r", "é́"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", ", ", "-"]) for _ in range(n))
    rows = [(k, text(rng.randrange(1, 60))) for k in range(300)]
    rows += [(400, None), (401, ""), (402, "... --"), (403, "word " * 60_000), (404, "x" * 70_000 + " y"), (None, text(40)), (5, rows[5][1]), (6, text(50))]
    return rows, [text(20) for _ in range(6)] + [None, ""]


def test_against_a_plain_version(spark):
    rows, target = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr) == plain(rows, target)


def test_other_columns_stay_and_results_replace_clashing_ones(spark):
    rows, target = corpus()
    docs = spark.createDataFrame([(k, t, "w", 7, "r") for k, t in rows], "doc_id long, text string, weight string, n int, rank string")
    out = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted(out.columns) == sorted(["doc_id", "n", "n_words", "n_features", "weight", "score", "rank"])
    assert sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr) == plain(rows, target)


@pytest.mark.parametrize("docs, target", [([], ["a b"]), ([(1, "a b c")], []), ([(1, None)], [None])])
def test_empty_tables(spark, docs, target):
    out = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect())) == plain(docs, target)


def test_shifted_crcs_are_those_of_the_joined_bytes():
    features = resampling.Features(order=4, buckets=1 << 32)
    text = "ab cde f " + "g" * 300 + " " + "h" * 5000 + " ab cde"
    words = text.split()
    _, runs = features(pa.array([text]))
    for n, (owner, run, crc) in enumerate(runs, 1):
        assert crc[run].tolist() == [zlib.crc32(" ".join(words[i:i + n]).encode()) for i in range(len(words) - n + 1)]


def test_several_slices_of_a_batch(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(f"W{rng.randrange(900)}" for _ in range(rng.randrange(10, 4000)))) for k in range(300)]  # about 3 MB
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = resampling.resample(docs, spark.createDataFrame([("w1 w2 W3",)], "text string"))
    assert sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr) == plain(rows, ["w1 w2 W3"])


def test_features_of_a_slice():
    texts = [f"Ab cd{i} EF" for i in range(100)]
    n_words, runs = resampling.Features()(pa.array(texts)[40:])
    assert n_words.tolist() == [3] * 60
    owner, run, bucket = runs[0]
    assert bucket[run].tolist() == [b for text in texts[40:] for b in plain_features(text)[1][:3]]
