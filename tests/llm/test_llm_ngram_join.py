"""N-gram Jaccard components against an inverted index in plain Python."""

import random
import re
from collections import Counter, defaultdict

from larder.llm import ngram_join
from larder.llm.components import connected_components

FOLDER = "/root/testdata/sf0.001"


def shingles(text, n=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)}


def brute(rows):
    sets, holders, parent = [shingles(t) for _, t in rows], defaultdict(list), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k, own in enumerate(sets):
        for j, common in Counter(j for g in own for j in holders[g]).items():
            if 100 * common >= 75 * (len(own) + len(sets[j]) - common):
                parent[root(k)] = root(j)
        for g in own:
            holders[g].append(k)
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[root(k)] = min(key, least.get(root(k), key))
    return sorted(((key, len(s), least.get(root(k)) if s else key) for k, ((key, _), s) in enumerate(zip(rows, sets))), key=repr)


def result(frame):
    return sorted((tuple(r) for r in ngram_join.ngram_components(frame).collect()), key=repr)


def variants(seed, count):
    rng = random.Random(seed)
    bases = [[rng.choice("abcdefghij") for _ in range(rng.randint(3, 40))] for _ in range(20)]
    rows = []
    for k in range(count):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice("abcdefghijXY")
        rows.append((rng.choice([k, k, k, None, 5]), " ".join(words)))
    return rows


def test_components_equal_brute_force_on_variants_and_odd_rows(spark):
    rows = variants(3, 200) + [(1, None), (2, ""), (3, "  \n"), (900, "a"), (901, "A"), (902, "x " * 3000), (903, "x " * 10), (904, "ä b")]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_components_equal_brute_force_on_documents_in_which_some_grams_are_hot(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_LOCAL", 2)
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    hot = "this very passage stands in a third of all the documents of the table " * 3
    rows += [(5000 + k, f"{hot} {k} {k + 1} {k + 2}") for k in range(150)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, size int, set_id string, component_id string"
    assert result(spark.createDataFrame([], schema)) == []
    assert result(spark.createDataFrame([(4, "a b", 1, "x", "y"), (2, "A  b", 1, "x", "y")], schema)) == [(2, 1, 2), (4, 1, 2)]


def test_keep_one_keeps_one_row_of_a_component_and_all_columns(spark, rows):
    table = [(7, "one two three", "a"), (3, "One two three", "b"), (3, "one two three", "c"), (8, "", "d"), (9, None, "e"), (1, "other", "f")]
    kept = ngram_join.keep_one(spark.createDataFrame(table, "doc_id long, text string, row string"))
    assert rows(kept, "row") == [("b",), ("d",), ("e",), ("f",)]


def test_connected_components_of_chains_stars_and_loops(spark, rows):
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = rows(connected_components(spark.createDataFrame(edges, "a long, b long")))
    want = [(k, 0) for k in range(21)] + [(k, 100) for k in range(100, 140)] + [(200, 200), (201, 200)]
    assert sorted(found) == sorted(want)
    assert rows(connected_components(spark.createDataFrame([], "a long, b long"))) == []
