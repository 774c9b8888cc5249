"""Product codes of vectors: dual-tree Lloyd over the parts of all vectors and the entries of the codebooks."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.arrow import prepare, with_field
from larder.llm.sizes import small
from larder.session import settle

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LEAF = 16  # parts in a leaf of the tree over the parts
BLOCK = 8192  # vectors that are put into one set of trees
LIMIT = 1 << 24  # components beyond saturate here, so that every distance and sum is exact in 64 bits


def quantised(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as integers."""
    return np.clip(np.floor(SCALE * x.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)


class Tree:
    """A balanced box tree over weighted points (rows of ``points``): level k has 2 ** k nodes.

    Every node is a run of equally many points, split at the median of its widest axis. The tree is padded with
    copies of the last point of weight 0. ``low`` and ``high`` bound the points of each node, ``count`` and ``total``
    are the cached number and sum of its points, ``order`` gives the rows of the points in the order of the leaves.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        n, width = points.shape
        levels = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
        size = max(1, -(-n // (1 << levels)))
        row = np.minimum(np.arange(size << levels), n - 1)
        weight = (np.arange(size << levels) < n).astype(np.int64)
        self.low, self.high, self.count, self.total = [], [], [], []
        for level in range(levels + 1):
            x = points[row].reshape(1 << level, -1, width)
            low, high = x.min(1), x.max(1)
            self.low.append(low)
            self.high.append(high)
            if level < levels:
                widest = np.argmax(high - low, axis=1)
                along = np.take_along_axis(x, widest[:, None, None], 2)[:, :, 0]
                half = along.shape[1] // 2
                at = np.argpartition(along, half, axis=1) if half else np.argsort(along, axis=1)
                row = np.take_along_axis(row.reshape(1 << level, -1), at, 1).ravel()
                weight = np.take_along_axis(weight.reshape(1 << level, -1), at, 1).ravel()
        self.order, self.weight = row.reshape(1 << levels, size), weight.reshape(1 << levels, size)
        count, total = self.weight.sum(1), (points[self.order] * self.weight[:, :, None]).sum(1)
        for _ in range(levels + 1):
            self.count.insert(0, count)
            self.total.insert(0, total)
            count, total = count.reshape(-1, 2).sum(1) if len(count) > 1 else count, total.reshape(-1, 2, width).sum(1) if len(total) > 1 else total

    @property
    def levels(self) -> int:
        return len(self.low) - 1


def _bounds(parts: Tree, at: int, entries: Tree, level: int, node: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between the boxes of pairs of nodes."""
    low, high = parts.low[at][node], parts.high[at][node]
    low_e, high_e = entries.low[level][group], entries.high[level][group]
    gap = np.maximum(np.maximum(low_e - high, low - high_e), 0)
    reach = np.maximum(high_e - low, high - low_e)
    return (gap * gap).sum(1), (reach * reach).sum(1)


def nearest(points: np.ndarray, parts: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of every point (ties: the lowest), and the number and the sum of the points of each entry.

    Both trees are walked down together. Of the groups of entries a node may belong to, those go whose least distance
    exceeds the largest distance of another. A node with one entry left is assigned as a whole, with its cached sum;
    the points of leaves that stay uncertain are compared with the entries left, in integers.
    """
    codes = np.zeros(len(points), np.int64)
    count, total = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
    entries = Tree(book, 1)
    node, group = np.zeros(1, np.int64), np.zeros(1, np.int64)  # pairs, in the order of the nodes
    at = level = 0
    while True:
        least, most = _bounds(parts, at, entries, level, node, group)
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        of = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(node)]))
        stay = least <= np.minimum.reduceat(most, first)[of]
        node, group = node[stay], group[stay]
        if level == entries.levels:
            real = entries.weight[group, 0] > 0  # padding stands for an entry that is there already
            node, group = node[real], group[real]
            left = np.bincount(node, minlength=1 << at)
            sure = left[node] == 1
            whole, entry = node[sure], entries.order[group[sure], 0]
            np.add.at(count, entry, parts.count[at][whole])
            np.add.at(total, entry, parts.total[at][whole])
            width = parts.levels - at
            leaves = (whole[:, None] << width) + np.arange(1 << width)
            codes[parts.order[leaves].ravel()] = np.repeat(entry, leaves.shape[1] * parts.order.shape[1])
            node, group = node[~sure], group[~sure]
            if not len(node):
                return codes, count, total
            if at == parts.levels:
                break
        for_parts, for_entries = int(at < parts.levels), int(level < entries.levels)
        if for_parts:
            pairs = np.bincount(node, minlength=1 << at)
            start = np.cumsum(pairs) - pairs
            here = np.flatnonzero(pairs)
            # both children of a node meet all of its groups, child by child
            take = np.concatenate([np.arange(start[n], start[n] + pairs[n]) for n in here for _ in (0, 1)])
            child = np.concatenate([np.full(pairs[n], 2 * n + c) for n in here for c in (0, 1)])
            node, group = child, group[take]
            at += 1
        if for_entries:
            node, group = np.repeat(node, 2), (2 * group[:, None] + np.arange(2)).ravel()
            level += 1
    entry = entries.order[group, 0]
    rows = parts.order[node]
    gaps = points[rows] - book[entry][:, None, :]
    keyed = (gaps * gaps).sum(2) * len(book) + entry[:, None]  # by distance, then by place in the codebook
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    best = np.minimum.reduceat(keyed, first, axis=0) % len(book)
    rows, real = parts.order[node[first]], parts.weight[node[first]] > 0
    codes[rows[real]] = best[real]
    np.add.at(count, best[real], 1)
    np.add.at(total, best[real], points[rows[real]])
    return codes, count, total


def usable_vectors(frame: DataFrame, vector: str, n_parts: int) -> DataFrame:
    """Rows whose vector has only finite components, and as many as can be cut into ``n_parts`` parts."""
    return frame.filter(F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                        & (F.size(vector) > 0) & (F.size(vector) % n_parts == 0))


def _blocks(batches, vector: str, n_parts: int, width: int):
    """Record batches of up to BLOCK rows, and for each part position the integer points and their tree."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            flat = part.column(vector).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, n_parts, width // n_parts)
            points = quantised(flat)
            yield part, [(points[:, p], Tree(points[:, p], LEAF)) for p in range(n_parts)]


def fit_codebooks(frame: DataFrame, vector: str, first: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks (part, entry, component) after some rounds of Lloyd that start from ``first``.

    In a round every task assigns its vectors and gives the counts and sums of the entries it used; Spark adds these
    up, and the driver gets one row per entry, however many vectors there are. Unused entries stay.
    """
    books, n_parts, width = first, first.shape[0], first.shape[0] * first.shape[2]
    prepare(frame.sparkSession)
    for _ in range(rounds):
        shared = frame.sparkSession.sparkContext.broadcast(books)  # entries times components

        def assign(batches):
            count, total = np.zeros(shared.value.shape[:2], np.int64), np.zeros(shared.value.shape, np.int64)
            for _, blocks in _blocks(batches, vector, n_parts, width):
                for p, (points, tree) in enumerate(blocks):
                    _, n, t = nearest(points, tree, shared.value[p])
                    count[p] += n
                    total[p] += t
            part, entry = np.nonzero(count)
            sums = total[part, entry]
            where = np.arange(len(part)).repeat(sums.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[where]), pa.array(entry[where]), pa.array(np.tile(np.arange(sums.shape[1]), len(part))),
                 pa.array(count[part, entry][where]), pa.array(sums.ravel())], ["part", "entry", "component", "n", "total"])

        sums = (frame.select(vector).mapInArrow(assign, "part long, entry long, component long, n long, total long")
                .groupBy("part", "entry", "component").agg(F.sum("n"), F.sum("total")).collect())
        books = books.copy()
        for part, entry, component, n, total in sums:
            books[part, entry, component] = total // n
    return books


def compress_vectors(frame: DataFrame, key: str = "vec_id", vector: str = "embedding", n_parts: int = PARTS, n_entries: int = ENTRIES,
                     rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The usable rows of ``frame`` with ``codes`` (one entry per part) and ``error``, and the codebooks (part, entry,
    component) as integers in units of 1 / SCALE.

    Rows whose vector is null or empty or holds null or non-finite components are dropped. So are vectors whose length
    is not that of the first one or no multiple of ``n_parts``: codes of different spaces cannot be compared. The
    codebooks start as the parts of the ``n_entries`` rows with the smallest keys (null keys last; of equal keys, by
    the vector). ``error`` is the squared distance to the chosen entries, summed over the parts. Repeated rows are rows
    of their own. Components are exact up to LIMIT / SCALE in size and saturate there. An empty table gives no rows
    and codebooks without entries. Columns named codes or error are replaced.
    """
    spark = prepare(frame.sparkSession)
    frame = usable_vectors(frame.drop("codes", "error"), vector, n_parts)
    starts = frame.select(key, vector).orderBy(F.asc_nulls_last(key), vector).limit(n_entries).collect()  # n_entries rows
    width = len(starts[0][1]) if starts else n_parts
    of_width = frame.filter(F.size(vector) == width)
    first = quantised(np.array([row[1] for row in starts if len(row[1]) == width], np.float64).reshape(-1, n_parts, width // n_parts)).transpose(1, 0, 2)
    books = fit_codebooks(of_width, vector, first, rounds) if starts else first
    shared = spark.sparkContext.broadcast(books)

    def code(batches):
        for part, blocks in _blocks(batches, vector, n_parts, width):
            codes, error = np.zeros((part.num_rows, n_parts), np.int32), np.zeros(part.num_rows, np.int64)
            for p, (points, tree) in enumerate(blocks):
                codes[:, p] = nearest(points, tree, shared.value[p])[0]
                gaps = points - shared.value[p][codes[:, p]]
                error += (gaps * gaps).sum(1)
            lists = pa.ListArray.from_arrays(np.arange(part.num_rows + 1, dtype=np.int32) * n_parts, codes.ravel())
            yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(error)], [*part.schema.names, "codes", "error"])

    schema: T.StructType = with_field(with_field(frame.schema, "codes", "array<int>"), "error", "long")
    return of_width.mapInArrow(code, schema), books


def label_errors(coded: DataFrame, label: str = "label", out: str = "label_error") -> DataFrame:
    """The rows with the error summed over equal labels, null labels together.

    The sums are made before anything is joined, so that a hot label costs a task one row.
    """
    coded = settle(coded, "codes")
    sums = settle(coded.groupBy(F.col(label).alias("__label")).agg(F.sum("error").alias(out)), "label-errors")
    return coded.drop(out).join(small(sums, 32), F.col(label).eqNullSafe(F.col("__label"))).drop("__label")


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position within the part, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
