"""N-gram Jaccard self-join of texts: rare-first prefix filtering with length, positional and suffix filters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.arrow import map_text, prepare, text_buffers
from larder.llm.components import connected_components
from larder.llm.ragged import distinct_per_row, gather, mix, ngram_hashes, word_hashes
from larder.llm.sizes import small
from larder.session import settle

BUCKET_ENTRIES = 1_500_000  # n-grams that one reduce group holds
HOT_SHARE = 0.001  # an n-gram in this share of the texts is hot: it is not counted exactly but ranks last
HOT_LOCAL = 3  # texts of one slice that must hold an n-gram before the slice reports it as a hot candidate
HOT_COUNT = np.uint32(2**32 - 1)
_LOW48 = np.uint64((1 << 48) - 1)


def _pack(values: np.ndarray) -> bytes:
    """48-bit values in six bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each text as 64-bit hashes (sorted, ragged), set sizes, and an id of each set."""
    words, where = word_hashes(*text_buffers(texts))
    grams, begin = distinct_per_row(*ngram_hashes(words, where, n))
    sizes = np.diff(begin)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(grams ^ _LOW48), dtype=np.uint64)))
    ids = mix(sums[begin[1:]] - sums[begin[:-1]] + sizes.astype(np.uint64))
    return grams, begin, sizes, (ids >> np.uint64(1)).astype(np.int64)


def describe(frame: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """Per row: key, set size, set id; and per slice of rows, on one of them, its hot candidates with counts."""
    kind = frame.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> dict:
        grams, begin, sizes, ids = _sets(batch.column(text), n)
        _, first = np.unique(ids, return_index=True)
        different = grams[gather(begin[first], sizes[first])]
        found, counts = np.unique(different, return_counts=True)
        hot = counts >= HOT_LOCAL
        empty = [[] for _ in range(len(sizes) - 1)]
        return {key: batch.column(key), "size": sizes, "set_id": ids,
                "hot": [found[hot].astype(np.int64).tolist(), *empty], "counts": [counts[hot].tolist(), *empty]}

    return map_text(frame.select(key, text), work,
                    f"`{key}` {kind}, size long, set_id long, hot array<long>, counts array<long>", text)


def shared_grams(frame: DataFrame, n: int, text: str, buckets: int, hot: np.ndarray) -> DataFrame:
    """Per different set: its n-grams that other sets hold too, and its rare-first prefix.

    Rows (set_id, size, alone, central, prefix, shared): ``shared`` packs the n-grams held by two sets or more; the
    ``alone`` others come first in the rare-first order and never match, so the prefix lists only what follows
    them. Sets whose whole prefix is unshared cannot have a partner and are left out. ``central`` says how common
    a set's n-grams are; of a group of variants, it is highest for the one the others derive from.

    The n-grams travel as packed arrays: slices of texts send them to hash buckets, where they are counted, and
    those that are shared go back to a bucket of their set. Copies are dropped on the way; hot n-grams take no
    detour through the count, so that none of them gathers in one task.
    """
    spark = prepare(frame.sparkSession)
    shared_hot = spark.sparkContext.broadcast(hot)

    def send(batch: pa.RecordBatch) -> dict | None:
        grams, begin, sizes, ids = _sets(batch.column(text), n)
        _, first = np.unique(ids, return_index=True)
        first = first[sizes[first] > 0]
        if not len(first):
            return None
        row = np.repeat(first, sizes[first])
        grams = grams[gather(begin[first], sizes[first])] & _LOW48
        known = shared_hot.value
        is_hot = np.zeros(len(grams), bool)
        if len(known):
            is_hot = known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams
        # hot n-grams go straight to the bucket of their set, numbered below zero
        bucket = np.where(is_hot, -1 - ids[row] % buckets, (grams % np.uint64(buckets)).astype(np.int64))
        return _blobs(bucket, ids[row], sizes[row], grams, None)

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        ids, sizes, grams, _ = _entries(table)
        order = np.lexsort((ids, grams))
        ids, sizes, grams = ids[order], sizes[order], grams[order]
        keep = np.ones(len(ids), bool)
        keep[1:] = (ids[1:] != ids[:-1]) | (grams[1:] != grams[:-1])
        ids, sizes, grams = ids[keep], sizes[keep], grams[keep]
        if bucket < 0:
            counts = np.full(len(ids), HOT_COUNT)
        else:
            heads = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
            runs = np.diff(np.append(heads, len(grams)))
            counts = np.repeat(np.minimum(runs, 2**32 - 2), runs).astype(np.uint32)
            keep = counts > 1
            ids, sizes, grams, counts = ids[keep], sizes[keep], grams[keep], counts[keep]
        return pa.table(_blobs(ids % buckets, ids, sizes, grams, counts), schema)

    def prefixes(table: pa.Table) -> pa.Table:
        ids, sizes, grams, counts = _entries(table)
        order = np.lexsort((grams, counts, ids))
        ids, sizes, grams, counts = ids[order], sizes[order], grams[order], counts[order]
        heads = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        runs = np.diff(np.append(heads, len(ids)))
        size = sizes[heads]
        alone = size - runs
        take = np.minimum(runs, prefix_length(size) - alone)
        central = np.add.reduceat(np.log2(counts), heads) / size
        out = {"set_id": [], "size": [], "alone": [], "central": [], "prefix": [], "shared": []}
        for k in np.flatnonzero(take > 0).tolist():
            own = grams[heads[k]:heads[k] + runs[k]]
            for name, value in zip(out, (ids[heads[k]], size[k], alone[k], central[k], own[:take[k]].astype(np.int64), _pack(np.sort(own)))):
                out[name].append(value)
        return pa.table(out, pa.schema([
            ("set_id", pa.int64()), ("size", pa.int64()), ("alone", pa.int64()), ("central", pa.float64()),
            ("prefix", pa.list_(pa.int64())), ("shared", pa.binary())]))

    ddl = "bucket long, ids binary, sizes binary, places binary, grams binary, counts binary"
    schema = pa.schema([("bucket", pa.int64()), *[(c, pa.binary()) for c in ("ids", "sizes", "places", "grams", "counts")]])
    return (map_text(frame.select(text), send, ddl, text)
            .groupBy("bucket").applyInArrow(count, ddl)
            .groupBy("bucket").applyInArrow(prefixes, "set_id long, size long, alone long, central double, prefix array<long>, shared binary"))


def prefix_length(size: np.ndarray) -> np.ndarray:
    """Longest prefix two sets of Jaccard 0.75 or more must share a member of: size - ceil(0.75 size) + 1."""
    return size - (3 * size + 3) // 4 + 1


def _blobs(bucket, ids, sizes, grams, counts) -> dict:
    """Entries packed into one row per bucket; the sets of a row are listed once and referred to by place."""
    order = np.argsort(bucket, kind="stable")
    bucket, ids, sizes, grams = bucket[order], ids[order], sizes[order], grams[order]
    counts = counts[order] if counts is not None else None
    cuts = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else [], len(bucket)).astype(int)
    out = {"bucket": [], "ids": [], "sizes": [], "places": [], "grams": [], "counts": []}
    for low, high in zip(cuts[:-1], cuts[1:]):
        sets, at, place = np.unique(ids[low:high], return_index=True, return_inverse=True)
        width = np.uint16 if len(sets) < 2**16 else np.uint32
        for name, value in zip(out, (int(bucket[low]), sets.tobytes(), sizes[low:high][at].astype(np.int64).tobytes(),
                                     place.astype(width).tobytes(), _pack(grams[low:high]),
                                     counts[low:high].tobytes() if counts is not None else b"")):
            out[name].append(value)
    return out


def _entries(table: pa.Table) -> tuple[np.ndarray, ...]:
    ids, sizes, grams, counts = [], [], [], []
    for row in range(table.num_rows):
        i, s, p, g, c = (table.column(name)[row].as_py() for name in ("ids", "sizes", "places", "grams", "counts"))
        i, s = np.frombuffer(i, np.int64), np.frombuffer(s, np.int64)
        p = np.frombuffer(p, np.uint16 if len(i) < 2**16 else np.uint32)
        ids.append(i[p])
        sizes.append(s[p])
        grams.append(_unpack(g))
        counts.append(np.frombuffer(c, np.uint32))
    return tuple(np.concatenate(x) for x in (ids, sizes, grams, counts))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the different pairs (a, b) whose sets have a Jaccard similarity of 0.75 or more."""
    prepare(pairs.sparkSession)
    side = sets.select("set_id", "size", "shared")

    def work(batches):
        for batch in batches:
            keep = []
            for a, b, m, n in zip(*(batch.column(c).to_pylist() for c in ("one", "two", "m", "n"))):
                a, b, least = _unpack(a), _unpack(b), -(-3 * (m + n) // 7)
                # suffix filter: cut both sets at the same members and add up the smaller parts
                marks = a[[len(a) // 4, len(a) // 2, 3 * len(a) // 4]] if len(a) >= 4 else a[:0]
                parts = [np.diff(np.concatenate(([0], np.searchsorted(x, marks), [len(x)]))) for x in (a, b)]
                if np.minimum(*parts).sum() < least:
                    keep.append(False)
                else:
                    keep.append(len(np.intersect1d(a, b, assume_unique=True)) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    joined = (pairs.join(side.select(F.col("set_id").alias("a"), F.col("size").alias("m"), F.col("shared").alias("one")), "a")
              .join(side.select(F.col("set_id").alias("b"), F.col("size").alias("n"), F.col("shared").alias("two")), "b"))
    return joined.select("a", "b", "one", "two", "m", "n").mapInArrow(work, "a long, b long")


def _can_link(m, n, alone_m, alone_n, i, j):
    """Length and positional filter for two sets of sizes m and n that meet on the i-th and j-th of their shared
    n-grams, as if it was their first common one: 3/7 (m + n) must be common, and no more can be than it and the
    smaller rest. A pair that links passes at its first common n-gram."""
    most = 1 + F.least(m - alone_m - i, n - alone_n - j)
    return (4 * F.least(m, n) >= 3 * F.greatest(m, n)) & (7 * most >= 3 * (m + n))


def set_links(sets: DataFrame) -> DataFrame:
    """Edges (a, b) between sets, enough to connect whatever is connected by links of 0.75 or more.

    Sets meet on prefix n-grams. Round one compares each set with one set only, the most central holder that most
    of its prefix n-grams name, which joins the members of large groups without comparing them all. Round two
    takes the pairs on any n-gram whose sets are in different components so far, with length and positional
    filters, and verifies each once. So no pair that could join two components goes unseen.
    """
    entries = settle(sets.select("set_id", "size", "alone", "central", F.posexplode("prefix").alias("i", "gram"))
                     .withColumn("i", F.col("i") + 1), "prefixes")
    heads = (entries.groupBy("gram").agg(F.max(F.struct("central", "set_id", "size", "alone", "i")).alias("head"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").drop("n"))
    votes = (entries.join(heads, "gram").filter("set_id != head.set_id")
             .filter(_can_link(F.col("size"), F.col("head.size"), F.col("alone"), F.col("head.alone"), F.col("i"), F.col("head.i")))
             .groupBy("set_id", F.col("head.set_id").alias("head")).agg(F.count(F.lit(1)).alias("n"), F.max("head.central").alias("central")))
    star = (votes.groupBy("set_id").agg(F.max(F.struct("n", "central", "head")).alias("best"))
            .select(F.least("set_id", "best.head").alias("a"), F.greatest("set_id", "best.head").alias("b")).distinct())
    first = settle(verified(star, sets), "links")
    components = connected_components(first)

    placed = settle(entries.join(components.withColumnRenamed("node", "set_id"), "set_id", "left")
                    .withColumn("component", F.coalesce("component", "set_id")), "placed")
    mixed = (placed.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("gram").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").drop("n"))
    mixed_rows = placed.join(mixed, "gram")
    fields = ("set_id", "size", "alone", "i", "component")
    left = mixed_rows.filter("component != main").select("gram", *[F.col(c).alias(f"{c}_a") for c in fields])
    right = mixed_rows.select("gram", "main", *[F.col(c).alias(f"{c}_b") for c in fields])
    met = left.join(right, "gram").filter(
        (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_b") == F.col("main")) | (F.col("set_id_a") < F.col("set_id_b")))
        & _can_link(*[F.col(f"{c}_{side}") for c in ("size", "alone", "i") for side in ("a", "b")]))
    possible = met.select(F.least("set_id_a", "set_id_b").alias("a"), F.greatest("set_id_a", "set_id_b").alias("b")).distinct()
    second = settle(verified(settle(possible, "candidates"), sets), "links")
    return first.unionAll(second)


def ngram_components(frame: DataFrame, n: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_shingles`` and ``component_id``, the smallest key reachable over links.

    Two texts link when the Jaccard similarity of their sets of ``n``-word shingles is 0.75 or more (A-Z in
    lower case, words are runs without ASCII white space; a shorter text is one shingle). A null text, or one
    without words, has an empty set and links with nothing: its component is its own key. Equal sets are one
    class and are compared once. Null keys are kept and never name a component unless nothing else is there;
    repeated rows each give a row; other columns are left out. Texts may be of any length. Sets are told
    apart by a 63-bit, shingles by a 48-bit hash of a 64-bit one.
    """
    spark = prepare(frame.sparkSession)
    rows = settle(describe(frame, n, key, text), "shingle-sets")
    total, texts = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    hot = (rows.select(F.explode(F.arrays_zip("hot", "counts")).alias("x")).groupBy("x.hot").agg(F.sum("x.counts").alias("n"))
           .filter(F.col("n") >= max(100, HOT_SHARE * texts)))
    # at most 1 / HOT_SHARE times the mean size of a set
    hot = np.unique(np.array([r[0] for r in hot.select("hot").collect()], np.int64).view(np.uint64) & _LOW48)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_ENTRIES))
    sets = settle(shared_grams(frame, n, text, buckets, hot), "shared")
    components = connected_components(set_links(sets))
    whole = rows.join(components.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        key, "size", F.coalesce("component", "set_id").alias("_class"))
    smallest = whole.groupBy("_class").agg(F.min(key).alias("_least"))
    return whole.join(smallest, "_class").select(
        key, F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("_least")).otherwise(F.col(key)).alias("component_id"))


def keep_one(frame: DataFrame, n: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``frame``, all columns, of which one stays per component of ``ngram_components``.

    The row with the smallest key stays (a null key counts as the smallest), and of rows with that key the one
    that comes first in the table. Rows without words are in no component and all stay.
    """
    row = "__row"
    marked = settle(frame.withColumn(row, F.monotonically_increasing_id()), "numbered")
    names = F.struct(F.col(key).alias("key"), F.col(row).alias("row")).alias("key")
    found = ngram_components(marked.select(names, F.col(text).alias("text")), n, "key", "text")
    gone = settle(found.filter("n_shingles > 0 AND NOT (key <=> component_id)").select(F.col("key.row").alias(row)), "gone")
    return marked.join(small(gone), row, "left_anti").drop(row)
