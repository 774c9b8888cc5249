"""A regression forest grown tree by tree inside Spark tasks, kept as a table of nodes.

Every tree has its own bootstrap of all rows and is grown to pure leaves, without a limit of depth. Nodes of many rows
are cut by aggregates, what is below them (a piece) in one task each; the tree is the same either way. The forest is a
table (tree, piece, node, feature, cut, category, left, right, n, value, gain) and never lies on the driver as a whole.
Targets are whole numbers of 1 / UNIT and leaf values whole numbers of 1 / VALUE, so sums are exact and the same
forest comes out whatever the order of rows and tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larder.session import drop_tables, settle, settled, ship_package

UNIT, VALUE = 10_000, 100_000_000
PIECE_ROWS = 500_000  # drawn rows up to which what is below a node is grown in one task
BATCH_BYTES = 24 << 20  # nodes that are broadcast at once for scoring
TREE_BYTES = 128 << 20  # nodes of a tree above which rows go to its pieces and not the tree to the rows
NODE_BYTES = 32
CATEGORY = -2  # number of the feature "is of this category"; numeric features count from 0, a leaf has LEAF
LEAF = -1
PIECE = -3  # while scoring: the first node of a piece
NODES = ("tree int, piece long, node long, feature int, cut double, category string, left long, right long, n long, value long, gain double")


def poisson_steps(rate: float) -> list[str]:
    """The cumulative Poisson probabilities as eight hexadecimal digits each, as far as they can be told apart."""
    steps, term, total, k = [], math.exp(-rate), 0.0, 0
    while True:
        total += term
        step = f"{math.floor(total * 2 ** 32):08x}"
        if len(step) > 8 or step == "ffffffff" or (steps and step == steps[-1]):
            return steps
        steps.append(step)
        k += 1
        term *= rate / k


def drawn_rows(rows: DataFrame, key: str, trees: int, rate: float, seed: int) -> DataFrame:
    """The rows that trees 0, 1, ... draw, with ``tree`` and ``w``, how often: Poisson, by a hash of seed, tree and key.

    One MD5 serves four trees with eight digits each; digits are compared as text.
    """
    name = F.concat(F.lit(f"{seed}:"), F.col("__four").cast("string"), F.lit(":"), F.col(key).cast("string"))
    fours = (rows.withColumn("__four", F.explode(F.sequence(F.lit(0), F.lit((trees - 1) // 4))))
             .withColumn("__hash", F.md5(name.cast("binary"))))
    each = F.array(*[F.struct((F.col("__four") * 4 + k).alias("tree"), F.substring("__hash", 8 * k + 1, 8).alias("__place")) for k in range(4)])
    placed = fours.select(*rows.columns, F.inline(each)).filter(F.col("tree") < trees)
    weight = reduce(add, [(F.col("__place") >= step).cast("long") for step in poisson_steps(rate)])
    return placed.filter(F.col("__place") >= poisson_steps(rate)[0]).withColumn("w", weight).drop("__place")


def _best_of_sorted(node, weight, total, x, n, s):
    """For rows sorted by node and x: the gain and cut of every place where a node can be cut."""
    sums_n, sums_s = np.cumsum(weight), np.cumsum(total)
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    before_n, before_s = np.r_[0, sums_n][first], np.r_[0, sums_s][first]
    at = np.flatnonzero((node[1:] == node[:-1]) & (x[1:] > x[:-1]))
    of = node[at]
    left_n, left_s = sums_n[at] - before_n[of], sums_s[at] - before_s[of]
    return of, _gain(left_n, left_s, n[of], s[of]), (x[at] + x[at + 1]) / 2


def _gain(part_n, part_s, n, s):
    a, b = part_s.astype(float), (s - part_s).astype(float)
    return a * a / part_n + b * b / (n - part_n)


def grow(features: Sequence[np.ndarray], category: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """The nodes of one tree, level by level.

    A node is cut where the squared error falls most; of equal cuts the first numeric feature, then the category, and
    of one feature the smallest wins. It is a leaf if its targets are equal or all its features are. ``category`` are
    codes in the order of their names.
    """
    out: dict[str, list] = {c: [] for c in ("feature", "cut", "code", "left", "right", "n", "value", "gain")}
    node = np.zeros(len(y), np.int64)
    made = 1
    while len(node):
        m = int(node.max()) + 1
        n, s = np.zeros((2, m), np.int64)
        np.add.at(n, node, weight)
        np.add.at(s, node, weight * y)
        low, high = np.full(m, np.iinfo(np.int64).max), np.full(m, np.iinfo(np.int64).min)
        np.minimum.at(low, node, y)
        np.maximum.at(high, node, y)
        found = []
        for number, values in enumerate(features):
            order = np.lexsort((values, node))
            of, gain, cut = _best_of_sorted(node[order], weight[order], (weight * y)[order], values[order], n, s)
            found.append((of, gain, np.full(len(of), number), cut, np.full(len(of), -1)))
        width = int(category.max()) + 1
        pair, of_row = np.unique(node * width + category, return_inverse=True)
        of, code = np.divmod(pair, width)
        part_n, part_s = np.zeros((2, len(pair)), np.int64)
        np.add.at(part_n, of_row, weight)
        np.add.at(part_s, of_row, weight * y)
        several = part_n < n[of]
        of, code, part_n, part_s = of[several], code[several], part_n[several], part_s[several]
        found.append((of, _gain(part_n, part_s, n[of], s[of]), np.full(len(of), len(features)), code.astype(float), code))
        of, gain, number, cut, code = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((cut, number, -gain, of))
        first = order[np.flatnonzero(np.r_[True, of[order][1:] != of[order][:-1]])] if len(order) else order
        first = first[low[of[first]] < high[of[first]]]
        feature, at, kind, gained = np.full(m, LEAF), np.zeros(m), np.full(m, -1), np.zeros(m)
        cut_nodes = of[first]
        feature[cut_nodes] = np.where(number[first] == len(features), CATEGORY, number[first])
        at[cut_nodes], kind[cut_nodes] = np.where(code[first] < 0, cut[first], 0), code[first]
        whole = s.astype(float)
        gained[cut_nodes] = gain[first] - (whole * whole / n)[cut_nodes]
        child = np.full(m, -1)
        child[cut_nodes] = made + 2 * np.arange(len(cut_nodes))
        for name, values in (("feature", feature), ("cut", at), ("code", kind), ("left", child), ("right", np.where(child < 0, -1, child + 1)),
                             ("n", n), ("value", (2 * s * (VALUE // UNIT) + n) // (2 * n)), ("gain", gained)):
            out[name].append(values)
        made += 2 * len(cut_nodes)
        lives = feature[node] != LEAF
        node, y, weight, category = node[lives], y[lives], weight[lives], category[lives]
        features = [f[lives] for f in features]
        right = category == kind[node]
        for number, values in enumerate(features):
            right = np.where(feature[node] == number, values > at[node], right)
        place = np.zeros(m, np.int64)
        place[cut_nodes] = 2 * np.arange(len(cut_nodes))
        node = place[node] + right
    return {name: np.concatenate(parts) for name, parts in out.items()}


def _spread(frame: DataFrame, *columns: str, least: int = 1) -> DataFrame:
    """The frame in as many partitions as there are tasks to fill: what follows costs time, not bytes."""
    spark = frame.sparkSession
    return frame.repartition(max(least, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *columns)


def _cut_by_aggregates(drawn: DataFrame, numbers: int, piece_rows: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of more than ``piece_rows`` drawn rows, and the rows below them with the ``node`` they have come to.

    Level by level, with the cuts that ``grow`` finds: of a node only sums by value are sorted, and its rows are moved to
    its children. Numbers of nodes are given tree by tree, those of two children follow each other.
    """
    spark, by, inputs = drawn.sparkSession, ["tree", "node"], [f"x{i}" for i in range(numbers)]
    sums = [F.count(F.lit(1)).alias("part_rows"), F.sum("w").alias("part_n"), F.sum(F.col("w") * F.col("y")).alias("part_s")]
    parts = ["part_rows", "part_n", "part_s"]
    ordered, twice = Window.partitionBy(*by).orderBy("x"), f"(2 * s * {VALUE // UNIT} + n)"
    rows, levels, pieces = settle(drawn.withColumn("node", F.lit(0).cast("long")), "forest-rows"), [], []
    rows_path = settled[-1]
    while not rows.isEmpty():
        whole = settle(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("s"),
                                             (F.min("y") < F.max("y")).alias("mixed")), "forest-wholes")
        cuts = [rows.groupBy(*by, F.col(x).alias("x")).agg(*sums).select(
            *by, F.lit(i).alias("feature"), ((F.col("x") + F.lead("x").over(ordered)) / 2).alias("cut"), F.lit(None).cast("string").alias("category"),
            *[F.sum(c).over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in parts]).filter("cut IS NOT NULL")
            for i, x in enumerate(inputs)]
        cuts.append(rows.groupBy(*by, "category").agg(*sums).select(*by, F.lit(CATEGORY).alias("feature"), F.lit(0.0).alias("cut"), "category", *parts))
        one, two = F.col("part_s").cast("double"), (F.col("s") - F.col("part_s")).cast("double")
        place = F.when(F.col("feature") == CATEGORY, numbers).otherwise(F.col("feature"))
        best = (reduce(DataFrame.unionAll, cuts).join(whole.filter("mixed").select(*by, "n", "s"), by).filter("part_n < n")
                .withColumn("parts", one * one / F.col("part_n") + two * two / (F.col("n") - F.col("part_n")))
                .groupBy(*by).agg(F.min_by(F.struct("feature", "cut", "category", "part_rows", "parts"),
                                           F.struct(-F.col("parts"), place, "cut", "category")).alias("best")))
        made = reduce(DataFrame.unionAll, levels).groupBy("tree").agg(F.max("right").alias("last")) if levels else None
        found = whole.join(best, by, "left")
        found = found.join(made, "tree", "left") if levels else found.withColumn("last", F.lit(0).cast("long"))
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("best").isNull(), "node"))
        is_cut, part, s = F.col("best").isNotNull(), F.col("best.part_rows"), F.col("s").cast("double")
        found = found.withColumn("left", F.when(is_cut, F.col("last") + 2 * rank - 1).otherwise(-1).cast("long")).select(
            *by, F.when(is_cut, F.col("best.feature")).otherwise(LEAF).cast("int").alias("feature"), F.coalesce("best.cut", F.lit(0.0)).alias("cut"),
            F.col("best.category").alias("category"), "left", F.when(is_cut, F.col("left") + 1).otherwise(-1).alias("right"), "n",
            F.expr(f"({twice} - pmod({twice}, 2 * n)) div (2 * n)").alias("value"),
            F.when(is_cut, F.col("best.parts") - s * s / F.col("n")).otherwise(0.0).alias("gain"),
            F.when(F.col("best.feature") == CATEGORY, F.col("rows") - part).otherwise(part).alias("left_rows"), "rows")
        level = settle(found, "forest-level")
        levels.append(level)
        goes_right = F.when(F.col("feature") == CATEGORY, F.col("category") == F.col("of")).otherwise(
            F.get(F.array(*inputs), F.greatest("feature", F.lit(0))) > F.col("cut"))
        moved = (rows.join(level.filter("left >= 0").select(*by, "feature", "cut", F.col("category").alias("of"), "left", "left_rows", "rows"), by)
                 .withColumn("goes_right", goes_right)
                 .withColumn("open", F.when(F.col("goes_right"), F.col("rows") - F.col("left_rows")).otherwise(F.col("left_rows")) > piece_rows)
                 .select("tree", *inputs, "category", "y", "w", (F.col("left") + F.col("goes_right").cast("long")).alias("node"), "open"))
        pieces.append(settle(moved.filter("NOT open").drop("open"), "forest-pieces"))
        rows = settle(moved.filter("open").drop("open"), "forest-rows")
        drop_tables(spark, [rows_path])
        rows_path = settled[-1]
    return reduce(DataFrame.unionAll, levels).drop("left_rows", "rows"), reduce(DataFrame.unionAll, pieces)


def _joined(top: DataFrame, pieces: DataFrame) -> DataFrame:
    """Nodes cut by aggregates and the pieces below, whose nodes are numbered on after them."""
    sizes = pieces.groupBy("tree", "piece").count()
    last = top.groupBy("tree").agg(F.greatest(F.max("right"), F.lit(0)).alias("last"))
    before = F.sum(F.col("count") - 1).over(Window.partitionBy("tree").orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)) - F.col("count") + 1
    shift = sizes.join(last, "tree").select("tree", "piece", (F.col("last") + before).alias("shift"))
    moved = lambda c: F.when(F.col(c) > 0, F.col(c) + F.col("shift"))
    numbered = pieces.join(F.broadcast(settle(shift, "forest-shift")), ["tree", "piece"]).withColumns(
        {"node": moved("node").otherwise(F.col("piece")), "left": moved("left").otherwise(-1), "right": moved("right").otherwise(-1)})
    columns = pieces.columns
    return top.withColumn("piece", F.lit(0).cast("long")).select(columns).unionAll(numbered.select(columns))


def fit_forest(rows: DataFrame, key: str, numbers: Sequence[str], category: str, target: str, trees: int = 200,
               sample_rows: int | None = None, seed: int = 42, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The settled nodes of a forest over rows with unique keys and no nulls in these columns.

    A row is drawn by a tree as often as Poisson with mean 1 says, however many rows there are; only a caller that names
    ``sample_rows`` has a lower mean, with which a tree expects that many of more rows. Trees are grown side by side,
    and of trees with more than ``piece_rows`` rows the pieces.
    """
    ship_package(rows.sparkSession)
    n_rows = rows.count()
    rate = 1.0 if sample_rows is None else min(1.0, sample_rows / max(1, n_rows))
    inputs = _spread(rows, key).select(key, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(numbers)],
                                       F.col(category).alias("category"), F.rint(F.col(target) * UNIT).cast("long").alias("y"))
    drawn = drawn_rows(inputs, key, trees, rate, seed).drop(key)
    n_numbers = len(numbers)

    def piece_nodes(keys, table):
        coded = table["category"].combine_chunks().dictionary_encode()
        names = np.array(coded.dictionary.to_pylist(), object)
        order = np.argsort(names)
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        made = grow([table[f"x{i}"].to_numpy() for i in range(n_numbers)], place[coded.indices.to_numpy()], table["y"].to_numpy(), table["w"].to_numpy())
        size = len(made["feature"])
        labels = pa.DictionaryArray.from_arrays(pa.array(made["code"], mask=made["code"] < 0), pa.array(names[order].tolist(), pa.string()))
        return pa.table({"tree": pa.array(np.full(size, keys[0].as_py()), pa.int32()), "piece": pa.array(np.full(size, keys[1].as_py(), np.int64)),
                         "node": pa.array(np.arange(size)), "feature": pa.array(made["feature"], pa.int32()),
                         "cut": made["cut"], "category": labels.cast(pa.string()), "left": made["left"], "right": made["right"],
                         "n": made["n"], "value": made["value"], "gain": made["gain"]})

    top = None
    if n_rows * -math.expm1(-rate) > piece_rows:  # rows a tree draws once or more
        top, drawn = _cut_by_aggregates(drawn, n_numbers, piece_rows)
    else:
        drawn = drawn.withColumn("node", F.lit(0).cast("long"))
    # dealt out by tree alone: a file holds few trees, in order, so that whoever wants some trees need not read all
    tasks = min(trees, math.ceil(n_rows * rate * trees / piece_rows))
    grown = settle(_spread(drawn, "tree", least=tasks).groupBy("tree", "node").applyInArrow(piece_nodes, NODES), "forest")
    return settle(_joined(top, grown), "forest") if top is not None else grown


def _batches(sizes: Sequence[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """Runs of trees whose nodes take up to ``limit`` bytes, or a single larger tree."""
    runs, room = [], 0
    for tree, size in sizes:
        if runs and size <= room:
            runs[-1] = (runs[-1][0], tree)
            room -= size
        else:
            runs.append((tree, tree))
            room = limit - size
    return runs


def _ends(feature, left, number, x, of, row, at):
    """Rows and the nodes in which they end, walking down from ``at``; ``x`` and ``of``: numbers and category of the rows."""
    while len(at):
        by = feature[at]
        ends = (by == LEAF) | (by == PIECE)
        yield row[ends], at[ends]
        row, at, by = row[~ends], at[~ends], by[~ends]
        goes_right = np.where(by == CATEGORY, of[row] == number[at], x[np.maximum(by, 0), row] > number[at])
        at = left[at] + goes_right  # the right child follows the left one


def _row_inputs(batch, n_numbers: int, names: dict):
    """Numbers, category codes and sums of the rows of a batch or table (__row, numbers, category, __sum)."""
    x = np.array([batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(n_numbers)], float).reshape(n_numbers, batch.num_rows)
    of = np.array([names.get(c, -2) for c in batch.column(1 + n_numbers).to_pylist()], np.int64)
    return x, of, batch.column(2 + n_numbers).to_numpy(zero_copy_only=False).copy()


def _add_run(summed: DataFrame, nodes, sizes: Sequence[int], names: dict, n_numbers: int) -> DataFrame:
    """The sums with the leaf values of the trees whose nodes are broadcast; ``sizes``, their numbers of nodes."""
    table = {c: nodes[c].to_numpy() for c in ("feature", "left", "number")}
    table["roots"], table["names"] = np.cumsum([0, *sizes])[:-1], names
    shared = summed.sparkSession.sparkContext.broadcast(table)

    def add_batch(batches):
        names, feature, number, roots = (shared.value[c] for c in ("names", "feature", "number", "roots"))
        left = shared.value["left"] + np.repeat(roots, np.diff(np.r_[roots, len(feature)]))
        for batch in batches:
            x, of, total = _row_inputs(batch, n_numbers, names)
            for row, at in _ends(feature, left, number, x, of, np.repeat(np.arange(batch.num_rows), len(roots)), np.tile(roots, batch.num_rows)):
                np.add.at(total, row, number[at].astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(total)], batch.schema.names)

    out = settle(summed.mapInArrow(add_batch, summed.schema), "scored")
    shared.unpersist()
    return out


def _add_pieces(summed: DataFrame, tree: DataFrame, names: dict, n_numbers: int) -> DataFrame:
    """The sums with the leaf values of one large tree: rows walk down the nodes above its pieces, which are broadcast,
    and meet the piece they come to."""
    above = (tree.filter("piece = 0 OR node = piece").orderBy("node")
             .select(F.when(F.col("piece") > 0, PIECE).otherwise(F.col("feature")).alias("feature"), "left", "number").toArrow())
    shared = summed.sparkSession.sparkContext.broadcast({"names": names} | {c: above[c].to_numpy() for c in above.column_names})
    schema = summed.schema
    placed_schema = StructType([*schema.fields, StructField("__piece", LongType())])

    def walk_down(batches):
        names, feature, left, number = (shared.value[c] for c in ("names", "feature", "left", "number"))
        for batch in batches:
            x, of, total = _row_inputs(batch, n_numbers, names)
            place = np.zeros(batch.num_rows, np.int64)
            for row, at in _ends(feature, left, number, x, of, np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)):
                leaf = feature[at] == LEAF
                total[row[leaf]] += number[at[leaf]].astype(np.int64)
                place[row] = np.where(leaf, 0, at)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(total), pa.array(place)], [*batch.schema.names, "__piece"])

    def add_piece(rows, nodes):
        rows = rows.drop_columns(["__piece"])
        if not rows.num_rows or not nodes.num_rows:
            return rows
        nodes = nodes.sort_by("node")  # the first node of a piece has a smaller number than those below, which follow each other
        feature, number = nodes["feature"].to_numpy(), nodes["number"].to_numpy()
        left = nodes["left"].to_numpy() - (nodes["node"][1].as_py() if nodes.num_rows > 1 else 0) + 1
        x, of, total = _row_inputs(rows, n_numbers, shared.value["names"])
        for row, at in _ends(feature, left, number, x, of, np.arange(rows.num_rows), np.zeros(rows.num_rows, np.int64)):
            total[row] += number[at].astype(np.int64)
        return rows.set_column(rows.num_columns - 1, "__sum", pa.array(total))

    placed = settle(summed.mapInArrow(walk_down, placed_schema), "placed")
    placed_path = settled[-1]
    below = tree.filter("piece > 0").select("piece", "node", "feature", "left", "number")
    met = _spread(placed.filter("__piece > 0"), "__piece").groupBy("__piece").cogroup(_spread(below, "piece").groupBy("piece")).applyInArrow(add_piece, schema)
    out = settle(placed.filter("__piece = 0").drop("__piece").unionAll(met), "scored")
    shared.unpersist()
    drop_tables(summed.sparkSession, [placed_path])
    return out


def score_forest(frame: DataFrame, forest: DataFrame, numbers: Sequence[str], category: str, out: str, batch_bytes: int = BATCH_BYTES,
                 tree_bytes: int = TREE_BYTES) -> DataFrame:
    """``frame`` with ``out``, the mean of the leaf values it falls into; null if the forest has no tree.

    Trees are broadcast in batches of up to ``batch_bytes``; a batch adds its leaf values to a whole-number sum and is
    given up before the next one. A node passes the driver as 14 bytes: feature, left child, and one number that is its
    cut, its category's code or its leaf value (whole numbers below 2 ** 53, so a double holds them exactly). Of a tree
    above ``tree_bytes`` only the nodes above its pieces pass the driver. Sums travel with the inputs only, which are
    numbered; the other columns are joined in the end.
    """
    spark = ship_package(frame.sparkSession)
    sizes = sorted(tuple(r) for r in forest.groupBy("tree").agg(
        F.sum(NODE_BYTES + F.coalesce(F.octet_length("category"), F.lit(0))), F.count(F.lit(1)), F.max("piece")).collect())  # a row per tree
    labels = [c for c, in forest.filter(F.col("feature") == CATEGORY).select("category").distinct().orderBy("category").collect()]  # a row per category
    codes = {c: i for i, c in enumerate(labels)}
    coded = F.broadcast(spark.createDataFrame(list(codes.items()), "category string, __code int"))
    number = F.when(F.col("feature") == LEAF, F.col("value")).when(F.col("feature") == CATEGORY, F.col("__code")).otherwise(F.col("cut")).cast("double")
    walked = forest.join(coded, "category", "left").withColumn("number", number)
    rows = settle(_spread(frame).withColumn("__row", F.monotonically_increasing_id()), "scored-rows")
    summed = rows.select("__row", *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(numbers)], F.col(category).alias("__category"),
                         F.lit(0).cast("long").alias("__sum"))
    before = None
    for low, high in _batches([(tree, size) for tree, size, _, _ in sizes], batch_bytes):
        run = [s for s in sizes if low <= s[0] <= high]
        part = walked.filter(F.col("tree").between(low, high))
        if run[0][1] > tree_bytes and run[0][3]:
            summed = _add_pieces(summed, part, codes, len(numbers))
        else:
            nodes = part.orderBy("tree", "node").select(F.col("feature").cast("short").alias("feature"), F.col("left").cast("int").alias("left"), "number").toArrow()
            summed = _add_run(summed, nodes, [n for _, _, n, _ in run], codes, len(numbers))
        if before:
            drop_tables(spark, [before])
        before = settled[-1]
    mean = F.col("__sum") / F.lit(float(len(sizes) * VALUE)) if sizes else F.lit(None).cast("double")
    return rows.join(summed.select("__row", "__sum"), "__row").withColumn(out, mean).select(*frame.columns, out)


def feature_weights(forest: DataFrame, numbers: Sequence[str], category: str) -> DataFrame:
    """(feature, importance): the share of a tree's error decrease that falls to a feature, averaged over the trees
    with at least one cut. Categories count one by one; features that never cut are left out."""
    name = F.when(F.col("feature") == CATEGORY, F.concat(F.lit(f"{category}_"), "category")).otherwise(
        F.get(F.array(*map(F.lit, numbers)), F.col("feature")))
    of_tree = forest.filter(F.col("feature") != LEAF).groupBy("tree", name.alias("feature")).agg(F.sum("gain").alias("gain"))
    whole = of_tree.groupBy("tree").agg(F.sum("gain").alias("whole")).filter("whole > 0")
    n_trees = whole.agg(F.count(F.lit(1)).alias("value")).scalar()
    return (of_tree.join(whole, "tree").groupBy("feature")
            .agg(F.sum(F.col("gain") / F.col("whole")).alias("total"))
            .select("feature", (F.col("total") / n_trees).alias("importance")))
