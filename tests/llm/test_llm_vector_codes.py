"""Codes of vectors against plain Lloyd rounds over all pairs, and the dual-tree search against all distances."""

import math

import numpy as np
import pytest

from larder.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, error string"


@pytest.mark.parametrize("n, width, k", [(1, 4, 1), (5, 4, 3), (17, 4, 64), (2000, 4, 64), (700, 1, 7), (500, 12, 64), (333, 2, 50)])
def test_dual_trees_find_what_all_distances_find(n, width, k):
    rng = np.random.default_rng(n)
    for spread in (2, 60, 2000, 1 << 23):
        points, book = rng.integers(-spread, spread, (n, width)), rng.integers(-spread, spread, (k, width))
        book[k // 2] = book[0]  # ties
        codes, count, total = vector_codes.nearest(points, vector_codes.Tree(points, vector_codes.LEAF), book)
        plain = ((points[:, None] - book[None]) ** 2).sum(2).argmin(1)
        assert (codes == plain).all() and (count == np.bincount(plain, minlength=k)).all()
        sums = np.zeros_like(book)
        np.add.at(sums, plain, points)
        assert (total == sums).all()


def plain_codes(rows, n_parts=16, n_entries=64, rounds=2):
    """Rows (key, codes, error, label error) and the codebooks, by comparing everything with everything."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in r[1]] for r in kept]).reshape(len(kept), n_parts, -1)
    books = x[:n_entries].copy()
    def assign():
        return ((x[:, None] - books[None]) ** 2).sum(3).argmin(1)
    for _ in range(rounds):
        codes = assign()
        for p in range(n_parts):
            for e in range(len(books)):
                mine = x[codes[:, p] == e, p]
                if len(mine):
                    books[e, p] = mine.sum(0) // len(mine)
    codes = assign()
    errors = [int(sum(((x[i, p] - books[codes[i, p], p]) ** 2).sum() for p in range(n_parts))) for i in range(len(kept))]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted(((r[0], tuple(c.tolist()), e, by_label[r[2]]) for r, c, e in zip(kept, codes, errors)), key=repr), books.transpose(1, 0, 2)


def found(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    coded, books = vector_codes.compress_vectors(frame)
    out = vector_codes.label_errors(coded)
    assert sorted(out.columns) == sorted(["vec_id", "embedding", "label", "codes", "error", "label_error"])
    return sorted(((r.vec_id, tuple(r.codes), r.error, r.label_error) for r in out.collect()), key=repr), books


def test_against_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 100)
    rng = np.random.default_rng(5)
    near = rng.normal(size=(40, 32))
    rows = [(k, [float(np.float32(c)) for c in near[k % 40] + rng.normal(scale=0.1, size=32)], k % 3 if k % 7 else None, "clash") for k in range(400)]
    bad = [None, [], [float("nan")] * 32, [float("inf")] + [0.0] * 31, [None] + [0.0] * 31, [1.0] * 48, [1.0] * 5]
    rows += [(500 + k, v, 1, None) for k, v in enumerate(bad)]
    rows += [(7, rows[7][1], 1, None), (7, rows[8][1], 2, None), (None, rows[9][1], None, None), (600, [0.0] * 32, 9, None), (601, [3.0] * 32, 9, None)]
    got, books = found(spark, rows)
    want, plain_books = plain_codes([r for r in rows if r[1] is None or len(r[1]) not in (5, 48)])
    assert got == want and (books == plain_books).all()


def test_few_rows_and_none(spark):
    rows = [(k, [float(k)] * 16, None, None) for k in range(3)] + [(9, None, 1, None)]
    got, books = found(spark, rows)
    assert got == plain_codes(rows)[0] and books.shape == (16, 3, 1)
    assert found(spark, [(1, None, 1, None)]) [0] == []
    assert found(spark, [])[0] == []


def test_huge_components_saturate(spark):
    got, _ = found(spark, [(1, [3e38] * 16, 1, None), (2, [-3e38] * 16, 1, None), (3, [1e38] * 16, 1, None)])
    assert [g[1][0] for g in got] == [0, 1, 0] and [g[2] for g in got] == [0, 0, 0]


def test_digest_joins_all_components():
    import hashlib
    books = np.array([[[1, -2], [3, 4]], [[5, 6], [7, 8]]])
    assert vector_codes.codebooks_digest(books) == hashlib.sha256(b"1,-2,3,4,5,6,7,8").hexdigest()
