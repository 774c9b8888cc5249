"""The forest against a plain recursive tree, and its table form."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import forest

SCHEMA = "id int, a double, b double, kind string, target double"


def table(n, seed=1):
    rng = random.Random(seed)
    return [(k, float(rng.randrange(12)), rng.randrange(5) / 2, rng.choice("xyz"), rng.randrange(9) / 10) for k in range(n)]


def plain_tree(rows):
    """rows: (a, b, kind code, y, w). Nested tuples (feature, cut, left, right), or a leaf's value."""
    n, s = sum(r[4] for r in rows), sum(r[3] * r[4] for r in rows)
    cuts = []
    for f in (0, 1):
        values = sorted({r[f] for r in rows})
        cuts += [(f, (x + y) / 2) for x, y in zip(values, values[1:])]
    cuts += [(2, c) for c in sorted({r[2] for r in rows}) if len({r[2] for r in rows}) > 1]
    if len({r[3] for r in rows}) == 1 or not cuts:
        return (2 * s * 10_000 + n) // (2 * n)

    def right(row, cut):
        return row[2] == cut[1] if cut[0] == 2 else row[cut[0]] > cut[1]

    def gain(cut):
        part_n, part_s = (sum(r[4] for r in rows if right(r, cut) == (cut[0] == 2)), sum(r[3] * r[4] for r in rows if right(r, cut) == (cut[0] == 2)))
        return float(part_s) * part_s / part_n + float(s - part_s) * (s - part_s) / (n - part_n)

    best = min(cuts, key=lambda c: (-gain(c), *c))
    return (*best, plain_tree([r for r in rows if not right(r, best)]), plain_tree([r for r in rows if right(r, best)]))


def nested(made, node=0):
    if made["feature"][node] == forest.LEAF:
        return int(made["value"][node])
    f = int(made["feature"][node])
    return (2 if f == forest.CATEGORY else f, int(made["code"][node]) if f == forest.CATEGORY else float(made["cut"][node]),
            nested(made, made["left"][node]), nested(made, made["right"][node]))


@pytest.mark.parametrize("n", [1, 2, 15, 200])
def test_a_tree_is_that_of_plain_recursion(n):
    rng = random.Random(n)
    rows = [(a, b, "xyz".index(kind), round(y * 10), rng.randrange(1, 4)) for _, a, b, kind, y in table(n)]
    a, b, kind, y, w = (np.array(c) for c in zip(*rows))
    assert nested(forest.grow([a.astype(float), b.astype(float)], kind, y, w)) == plain_tree(rows)


def test_depth_has_no_limit():
    x = np.arange(200.0)
    y = (3 ** np.minimum(x, 30)).astype(np.int64) // 10 ** 6  # every cut takes off the largest value
    made = forest.grow([x], np.zeros(200, np.int64), y, np.ones(200, np.int64))
    depth = {0: 0}
    for node, left in enumerate(made["left"].tolist()):
        if left >= 0:
            depth[left] = depth[left + 1] = depth[node] + 1
    assert max(depth.values()) > 12 and (made["n"][made["feature"] == forest.LEAF] > 0).all()


def test_scores_do_not_depend_on_batches_or_partitions(spark):
    rows = spark.createDataFrame(table(300), SCHEMA)
    model = forest.fit_forest(rows, "id", ["a", "b"], "kind", "target", trees=7)
    again = forest.fit_forest(rows.repartition(5), "id", ["a", "b"], "kind", "target", trees=7)
    assert model.exceptAll(again).count() == 0 and model.select("tree").distinct().count() == 7
    new = rows.withColumn("kind", F.when(F.col("id") % 50 == 0, "unseen").otherwise(F.col("kind")))
    whole = forest.score_forest(new, model, ["a", "b"], "kind", "score")
    cut = forest.score_forest(new.repartition(3), model, ["a", "b"], "kind", "score", batch_bytes=1)
    assert whole.exceptAll(cut).count() == 0 and whole.columns == [*rows.columns, "score"]
    assert whole.filter("score IS NULL OR score < 0 OR score > 0.8").count() == 0


def test_the_sample_of_a_tree_is_bounded_and_draws_repeat_with_the_seed(spark):
    rows = spark.createDataFrame(table(4000), SCHEMA)
    size = lambda **how: {r.tree: r.n for r in forest.fit_forest(rows, "id", ["a", "b"], "kind", "target", 6, **how).filter("node = 0").collect()}
    bounded = size(sample_rows=500)
    assert len(bounded) == 6 and all(400 < n < 600 for n in bounded.values())
    assert size() == size() != size(seed=7) and all(3700 < n < 4300 for n in size().values())


def test_no_rows_give_no_tree_and_null_scores(spark):
    rows = spark.createDataFrame([], SCHEMA)
    model = forest.fit_forest(rows, "id", ["a", "b"], "kind", "target", trees=3)
    assert model.count() == 0
    some = spark.createDataFrame(table(3), SCHEMA)
    assert [r.score for r in forest.score_forest(some, model, ["a", "b"], "kind", "score").collect()] == [None] * 3
    assert forest.feature_weights(model, ["a", "b"], "kind").count() == 0


def test_a_node_passes_the_driver_as_few_bytes(spark, monkeypatch):
    seen = []
    rows = spark.range(300).selectExpr(
        "id", "cast(id % 17 as double) as a", "cast(id % 5 as double) as b", "concat('a long name of a kind ', id % 3) as kind", "cast(id % 11 as double) / 10 as target")
    model = forest.fit_forest(rows, "id", ["a", "b"], "kind", "target", trees=5)
    plain = type(rows).toArrow
    monkeypatch.setattr(type(rows), "toArrow", lambda frame: seen.append(plain(frame)) or seen[-1])
    forest.score_forest(rows, model, ["a", "b"], "kind", "score").collect()
    assert sum(t.num_rows for t in seen) == model.count()
    assert sum(t.nbytes for t in seen) <= 16 * model.count()


def paths(model):
    """The nodes of every tree by the way to them from its root, without their numbers."""
    trees = {}
    for r in model.collect():
        trees.setdefault(r.tree, {})[r.node] = r
    out = set()
    for tree, nodes in trees.items():
        assert sorted(nodes) == list(range(len(nodes)))
        todo = [(0, "")]
        while todo:
            node, way = todo.pop()
            r = nodes.pop(node)
            out.add((tree, way, r.feature, r.cut, r.category, r.n, r.value, r.gain))
            if r.left >= 0:
                assert r.right == r.left + 1
                todo += [(r.left, way + "l"), (r.right, way + "r")]
        assert not nodes
    return out


def test_the_rows_a_tree_draws_do_not_depend_on_how_many_there_are(spark):
    rows = spark.range(150_000).selectExpr(
        "id", "cast(id % 3 as double) as a", "cast(id % 2 as double) as b", "'x' as kind", "cast(id % 7 as double) / 10 as target")
    roots = forest.fit_forest(rows, "id", ["a", "b"], "kind", "target", trees=2).filter("node = 0").collect()
    assert len(roots) == 2 and all(148_000 < r.n < 152_000 for r in roots)


def test_a_forest_grown_in_pieces_is_the_one_grown_whole(spark):
    # 100 equal rows, and 100 that differ in the target only, are leaves of more rows than a piece has
    rows = spark.createDataFrame(table(200) + [(200 + k, 3.0, 1.0, "z", 0.5) for k in range(100)] + [(300 + k, 30.0, 1.0, "q", k % 2 / 2) for k in range(100)], SCHEMA)
    whole = forest.fit_forest(rows, "id", ["a", "b"], "kind", "target", trees=2)
    model = forest.fit_forest(rows, "id", ["a", "b"], "kind", "target", trees=2, piece_rows=50)
    assert model.filter("piece > 0").count() and model.filter("piece = 0 AND feature = -1").count()
    assert paths(model) == paths(whole)
    new = rows.withColumn("kind", F.when(F.col("id") % 50 == 0, "unseen").otherwise(F.col("kind")))
    scores = forest.score_forest(new, whole, ["a", "b"], "kind", "score")
    for limit in (1, 1 << 20):
        again = forest.score_forest(new, model, ["a", "b"], "kind", "score", limit, limit)
        assert again.exceptAll(scores).count() == 0 and again.count() == 400


def test_negative_targets_round_alike_in_pieces(spark):
    rows = spark.createDataFrame([(k, float(k % 4), 0.0, "x", -(k % 7) / 3) for k in range(50)], SCHEMA)
    fit = lambda n: paths(forest.fit_forest(rows, "id", ["a", "b"], "kind", "target", trees=1, piece_rows=n))
    assert fit(8) == fit(1000)
