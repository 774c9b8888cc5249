"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from larder.llm import near_vectors

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    def usable(vector, label):
        return (label is not None and bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector))

    parent, count = list(range(len(rows))), [0] * len(rows)

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a, (_, v, label) in enumerate(rows):
        for b in range(a):
            _, w, other = rows[b]
            if usable(v, label) and usable(w, other) and label == other and len(v) == len(w):
                if np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                    count[a], count[b] = count[a] + 1, count[b] + 1
                    parent[root(a)] = root(b)
    least = {}
    for k, (key, _, _) in enumerate(rows):
        if key is not None:
            least[root(k)] = min(key, least.get(root(k), key))
    return sorted(((key, count[k], least.get(root(k))) for k, (key, _, _) in enumerate(rows)), key=repr)


def result(frame):
    return sorted((tuple(r)[:3] for r in near_vectors.vector_links(frame).collect()), key=repr)


def test_links_equal_all_pairs_with_odd_rows_and_split_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "TILE", 8)
    rng = np.random.default_rng(1)
    rows = []
    for group in range(4):
        base = rng.normal(size=20)
        rows += [(len(rows) + k, (base + rng.normal(size=20) * 0.09 * np.linalg.norm(base) / 20 ** 0.5).tolist(), group % 2)
                 for k in range(25)]
    rows += [(1000, None, 1), (1001, [0.0] * 20, 1), (1002, [float("nan")] * 20, 1), (1003, [None] * 20, 1), (1004, [1.0] * 20, None),
             (None, [1.0] * 20, 1), (1006, [1.0] * 20, 1), (1006, [1.0] * 20, 1), (1007, [2.0] * 5, 1), (1008, [4.0] * 5, 1),
             (1009, [], 1), (1010, [-0.0, 1.0, 0.0], 1), (1011, [0.0, 1.0, -0.0], 1), (1012, [float("inf")] * 3, 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got, want = result(frame), brute(rows)
    assert got == want
    kept = {r.vec_id: r.kept for r in near_vectors.vector_links(frame).collect()}
    assert kept[1007] and not kept[1008] and kept[1009]


def test_recall_on_random_neighbours(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(400, 64))
    near = base + rng.normal(size=base.shape) * 0.16 * np.linalg.norm(base, axis=1, keepdims=True) / 8
    vectors = np.concatenate((base, near))
    rows = [(k, v.tolist(), 0) for k, v in enumerate(vectors)]
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    wanted = np.count_nonzero(units @ units.T >= 0.98) - len(rows)
    found = sum(r[1] for r in result(spark.createDataFrame(rows, SCHEMA)))
    assert 0.97 * wanted <= found <= wanted and wanted > 300


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 3)]])
def test_tables_without_pairs_and_clashing_columns(spark, rows):
    frame = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA + ", n_links int, class string")
    assert result(frame) == [(r[0], 0, r[0]) for r in rows]
