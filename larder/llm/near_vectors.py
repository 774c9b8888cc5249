"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.arrow import prepare
from larder.llm.components import connected_components
from larder.llm.ragged import gather, mix
from larder.session import settle

TABLES, HASHES, PROBES = 10, 3, 3  # hash tables, rotations per table, buckets of a vector in each table
TILE = 1024  # members of a bucket that are compared with as many others in one group
GROUP_ROWS = 40_000  # members of small buckets that share a group
PAIR_BLOCK = 100_000
_SEED = 77


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row; the row length is a power of two."""
    rows, size = x.shape
    step = 1
    while step < size:
        y = x.reshape(rows, size // (2 * step), 2, step)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(rows, size)
        step *= 2
    return x / np.sqrt(size)


def bucket_codes(x: np.ndarray) -> np.ndarray:
    """Bucket codes (rows, TABLES, PROBES) of unit vectors.

    A rotation is three rounds of random signs and a Hadamard transform; its hash is the closest signed axis.
    The first probe takes the closest axes of all rotations, the others move one rotation to its second axis
    where that costs least.
    """
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), size))
    padded[:, :x.shape[1]] = x
    signs = np.random.default_rng(_SEED + size).choice([-1.0, 1.0], (TABLES, HASHES, 3, size))
    out = np.zeros((len(x), TABLES, PROBES), np.uint64)
    rows = np.arange(len(x))
    for t in range(TABLES):
        best, second, cost = np.zeros((3, len(x), HASHES))
        for h in range(HASHES):
            y = padded
            for turn in range(3):
                y = hadamard(y * signs[t, h, turn])
            size_of = np.abs(y)
            top = np.argpartition(size_of, -2, axis=1)[:, -2:]
            values = np.take_along_axis(size_of, top, 1)
            order = np.argsort(-values, axis=1, kind="stable")
            top, values = np.take_along_axis(top, order, 1), np.take_along_axis(values, order, 1)
            axes = 2 * top + (np.take_along_axis(y, top, 1) < 0)
            best[:, h], second[:, h], cost[:, h] = axes[:, 0], axes[:, 1], values[:, 0] - values[:, 1]
        cheapest = np.argsort(cost, axis=1, kind="stable")
        for p in range(PROBES):
            axes = best.copy()
            if p:
                moved = cheapest[:, p - 1]
                axes[rows, moved] = second[rows, moved]
            code = np.full(len(x), t + 1, np.uint64)
            for h in range(HASHES):
                code = code * np.uint64(2 * size + 1) + axes[:, h].astype(np.uint64)
            out[:, t, p] = code
    return out


def _hashed(classes: DataFrame) -> DataFrame:
    """Per class: its bucket keys (label and length are part of a key) and its unit vector."""
    def work(batches):
        for batch in batches:
            lists = batch.column("embedding")
            lengths = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            begin = np.cumsum(lengths) - lengths
            salt = batch.column("salt").to_numpy().astype(np.uint64)
            keys = np.zeros((len(lengths), TABLES * PROBES), np.int64)
            units = [b""] * len(lengths)
            for size in np.unique(lengths):
                at = np.flatnonzero(lengths == size)
                x = flat[gather(begin[at], lengths[at])].reshape(-1, size)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                codes = bucket_codes(x).reshape(len(at), -1)
                keys[at] = np.sort(mix(mix(codes) ^ salt[at][:, None]).view(np.int64), axis=1)
                for row, unit in zip(at.tolist(), x):
                    units[row] = unit.tobytes()
            yield pa.RecordBatch.from_pydict({
                "class": batch.column("class"), "copies": batch.column("copies"),
                "keys": pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1], keys.ravel()),
                "unit": pa.array(units, pa.binary())})

    return settle(classes.mapInArrow(work, "class long, copies long, keys array<long>, unit binary"), "hashed")


def _linked(table: pa.Table, least: float) -> pa.Table:
    """Links inside the buckets of a group: per class the copies it links to and a class it is connected with.

    A pair counts only in the smallest bucket its two classes have in common, so that it is counted once.
    """
    table = table.combine_chunks()
    bucket, side = table.column("bucket").to_numpy(), table.column("side").to_numpy()
    ids, copies = table.column("class").to_numpy(), table.column("copies").to_numpy()
    order = np.lexsort((ids, side, bucket))
    bucket, side, ids, copies = bucket[order], side[order], ids[order], copies[order]
    units = table.column("unit").chunk(0) if table.num_rows else None
    keys = np.array(table.column("keys").combine_chunks().flatten()).reshape(len(ids), -1)[order]
    x = [np.frombuffer(units[k].as_py(), np.float64) for k in order.tolist()]
    width = max(v.size for v in x)  # a bucket holds vectors of one length; padding with zeros changes no product
    x = np.stack([np.pad(v, (0, width - v.size)) if v.size < width else v for v in x])
    names, place = np.unique(ids, return_inverse=True)
    weight, root = np.zeros(len(names), np.int64), np.arange(len(names))
    # partners of a row: the rows after it in its bucket, or for a row of side 1 those of side 2 (a tile between
    # two parts of a bucket holds sides 1 and 2 only)
    end = np.searchsorted(bucket, bucket, "right")
    start = np.arange(len(ids)) + 1
    if side.any():
        second = np.flatnonzero(side == 2)
        start[side == 1] = second[0] if len(second) else len(ids)
        end[side == 2] = start[side == 2]
    lengths = np.maximum(end - start, 0)
    cuts = np.append(0, np.cumsum(lengths))
    low = 0
    links = []
    while low < len(ids):
        high = max(low + 1, int(np.searchsorted(cuts, cuts[low] + PAIR_BLOCK, "right")) - 1)
        a = np.repeat(np.arange(low, high), lengths[low:high])
        b = gather(start[low:high], lengths[low:high])
        different = ids[a] != ids[b]
        a, b = a[different], b[different]
        if len(a):
            close = np.einsum("ij,ij->i", x[a], x[b]) >= least
            a, b = a[close], b[close]
            earlier = np.zeros(len(a), bool)
            for k in range(keys.shape[1]):
                own = keys[a, k]
                earlier |= (own < bucket[a]) & (keys[b] == own[:, None]).any(axis=1)
            a, b = a[~earlier], b[~earlier]
            links.append((place[a], place[b]))
            np.add.at(weight, place[a], copies[b])
            np.add.at(weight, place[b], copies[a])
        low = high
    if links:
        a, b = (np.concatenate(x) for x in zip(*links))
        while True:
            before = root.copy()
            least_root = np.minimum(root[a], root[b])
            np.minimum.at(root, a, least_root)
            np.minimum.at(root, b, least_root)
            root = root[root]
            if (root == before).all():
                break
    touched = weight > 0
    return pa.table({"class": names[touched], "n": weight[touched], "root": names[root[touched]]})


def vector_links(frame: DataFrame, least: float = 0.98, key: str = "vec_id", vector: str = "embedding",
                 label: str = "label") -> DataFrame:
    """Per row: ``key``, ``n_links`` (other rows linked directly), ``component_id`` (the smallest key reachable
    over links, itself included) and ``kept`` (the key is its component's).

    Rows link when their labels are equal and not null and the cosine of their vectors, in double precision,
    is ``least`` or more; only vectors of one length are compared. A vector that is null, empty, zero or holds
    a null, NaN or infinity links with nothing. Equal vectors of a label are one class and all link. Other
    pairs are found if they share a bucket in one of the hash tables; every link returned is verified. Large
    buckets are cut into tiles of 1024 x 1024 members, and links are counted where they are found, so pairs
    are never written out. Null keys name a component only if nothing else does; other columns are left out.
    """
    spark = prepare(frame.sparkSession)
    values = F.transform(F.col(vector).cast("array<double>"), lambda v: v + F.lit(0.0))  # -0.0 becomes 0.0
    usable = (F.col(label).isNotNull() & F.coalesce(F.size(values) > 0, F.lit(False))
              & F.coalesce(F.forall(values, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))), F.lit(False))
              & F.coalesce(F.exists(values, lambda v: v != 0), F.lit(False)))
    rows = settle(frame.select(
        F.col(key).alias("key"), F.when(usable, values).alias("embedding"),
        F.when(usable, F.xxhash64(F.col(label), values)).alias("class"),
        F.when(usable, F.xxhash64(F.col(label), F.size(values))).alias("salt")), "vectors")
    counted = rows.filter("class IS NOT NULL").groupBy("class", "salt", "embedding").agg(
        F.count(F.lit(1)).alias("copies"))
    hashed = _hashed(counted)
    members = hashed.select("class", F.explode(F.array_distinct("keys")).alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    full = settle(members.join(sizes, "bucket"), "buckets")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(parts, -(-full.count() // GROUP_ROWS))
    pieces = F.ceil(F.col("size") / TILE)
    own = F.pmod(F.xxhash64("class"), pieces)
    # a large bucket's members go to one tile per other part, on side 1 or 2, and to the tile of their own part
    tiles = F.transform(F.sequence(F.lit(0).cast("long"), pieces - 1), lambda k: F.struct(
        F.least(own, k).alias("i"), F.greatest(own, k).alias("j"),
        F.when(own == k, 0).when(own < k, 1).otherwise(2).alias("side")))
    placed = full.select("class", "bucket", "size", F.explode(tiles).alias("t")).select(
        "class", "bucket", "t.side", F.when(F.col("size") <= TILE, F.pmod(F.xxhash64("bucket"), F.lit(groups)))
        .otherwise(F.xxhash64("bucket", "t.i", "t.j")).alias("group"))
    found = settle(placed.join(hashed, "class").groupBy("group").applyInArrow(
        lambda table: _linked(table, least), "class long, n long, root long"), "vector-links")
    links = found.groupBy("class").agg(F.sum("n").alias("links"))
    components = connected_components(found, "class", "root").withColumnRenamed("node", "class")
    placed_rows = (rows.join(counted.select("class", "copies"), "class", "left").join(links, "class", "left")
                   .join(components, "class", "left")
                   .select("key", "class", (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                           F.coalesce("component", "class").alias("component")))
    smallest = placed_rows.filter("component IS NOT NULL").groupBy("component").agg(F.min("key").alias("least"))
    component_id = F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("least"))
    return placed_rows.join(smallest, "component", "left").select(
        F.col("key").alias(key), "n_links", component_id.alias("component_id"),
        F.col("key").eqNullSafe(component_id).alias("kept"))
