"""Exact deduplication as a stream: digests in disk-backed keyed state, full bytes compared wherever a digest is hit."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.sizes import BROADCAST_BYTES, small
from larder.session import configure, scratch_root, settle

GROUP_SHARE = 1000  # members of a group that are compared with their keeper in one salted part
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # each open store takes some MB of an executor's disk, however little it holds
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case, nothing else changed; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    only_ascii = F.octet_length(whole) == F.length(whole)
    return F.when(only_ascii, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@contextmanager
def _state_settings(spark: SparkSession):
    before = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stream of the Parquet files of a folder, or of a single file."""
    reader = spark.readStream.schema(schema)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getFileStatus(place).isFile():
        reader, path = reader.option("pathGlobFilter", place.getName()), place.getParent().toString()
    return reader.parquet(path)


def _with_locator(frame: DataFrame, *columns: Column) -> DataFrame:
    """The columns with the place of their row: the file and the position in it."""
    place = frame.metadataColumn("_metadata")
    return frame.select(*columns, place["file_path"].alias("file"), place["row_index"].alias("position"))


def _drain(writer, checkpoint: str) -> None:
    """Run a streaming query over all that has arrived."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def digest_state(spark: SparkSession, path: str, state: str, key: str = "doc_id", text: str = "text",
                 digest: Callable[[Column], Column] = sha256) -> tuple[DataFrame, DataFrame]:
    """Take the files that are new since the last call with this ``state`` folder into the state.

    Two chained streams: the first writes a row (id, digest, size, file, position) per document, hashing each text
    once. The second keeps one entry per digest in RocksDB, without expiry: the number of rows and, as the row that
    stays, the one with the largest id (of equal ids, the last by file and position) with its locator. Rows of one
    digest are combined before they are shuffled, so a hot text costs its task one row a batch and partition. Both
    streams go on where their checkpoints end, so a lost executor or driver costs a batch. Returns the rows, and the
    entries (digest, keep, n) as they stand in the state.
    """
    schema = spark.read.parquet(path).schema
    content = normalised(F.col(text))
    rows = _with_locator(_stream(spark, path, schema), F.col(key).alias("id"), digest(content).alias("digest"),
                         F.octet_length(content).cast("long").alias("size"))
    _drain(rows.writeStream.format("parquet").option("path", f"{state}/rows"), f"{state}/rows-progress")
    hashed = spark.read.schema(rows.schema).parquet(f"{state}/rows")
    entries = spark.readStream.schema(rows.schema).parquet(f"{state}/rows").groupBy("digest").agg(
        F.max(F.struct("id", "file", "position")).alias("keep"), F.count(F.lit(1)).alias("n"))
    with _state_settings(spark):
        _drain(entries.writeStream.format("noop").outputMode("update"), f"{state}/digests")
    if hashed.isEmpty():  # nothing has been committed that could be read
        return hashed, spark.createDataFrame([], T.StructType([
            rows.schema["digest"], T.StructField("keep", T.StructType([rows.schema[c] for c in ("id", "file", "position")])),
            T.StructField("n", T.LongType())]))
    kept = spark.read.format("statestore").load(f"{state}/digests").select("key.*", "value.*")
    return hashed, kept.toDF("digest", "keep", "n")


def _bodies(spark: SparkSession, path: str, text: str, members: DataFrame) -> DataFrame:
    """The members with their normalised texts, read again at their locators."""
    texts = _with_locator(spark.read.parquet(path), F.col(text).alias("text"))
    return (texts.join(small(members, 48 + F.octet_length("digest") + F.octet_length("file")), ["file", "position"])
            .withColumn("text", normalised(F.col("text"))))


def collisions(spark: SparkSession, path: str, text: str, members: DataFrame) -> DataFrame:
    """Digests under which different texts lie: the full bytes of each member are compared with those of its keeper.

    A group is cut into parts of about GROUP_SHARE members, each with a copy of the keeper, so that no task compares
    a whole hot group.
    """
    parts = F.ceil(F.col("n") / GROUP_SHARE)
    bodies = _bodies(spark, path, text, members)
    keepers = bodies.filter("keeper").select("digest", F.col("text").alias("kept_text"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    others = bodies.filter("NOT keeper").select("digest", "text", F.pmod(F.xxhash64("file", "position"), parts).alias("part"))
    if (members.filter("keeper").agg(F.sum(parts * (F.col("size") + 64))).first()[0] or 0) <= BROADCAST_BYTES:
        keepers = F.broadcast(keepers)
    return others.join(keepers, ["digest", "part"]).filter("text != kept_text").select("digest").distinct()


def exact_duplicates(spark: SparkSession, path: str, state: str | None = None, key: str = "doc_id", text: str = "text",
                     digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document of a Parquet table: ``key``, ``keep_id``, ``group_size``, ``kept`` and ``digest``.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal texts the row with
    the largest key stays; of equal keys the last by file and position, so that exactly one stays; null keys come
    first. ``state`` names a folder that all machines share and that a later call, after files were added to the
    table, goes on with; without it the state lives in the run's folder. Whole texts are read, of any length. An
    empty table gives no rows. Other columns are not read, whatever their names.

    Texts are told apart by ``digest`` first and, on a hit, by their full bytes; where different texts share a digest,
    its rows are grouped by the texts themselves.
    """
    configure(spark)
    state = state or f"{scratch_root(spark)}/exact-{uuid.uuid4().hex}"
    rows, entries = digest_state(spark, path, state, key, text, digest)
    repeated = settle(entries.filter("n > 1"), "repeated-digests")
    width = 64 + F.octet_length("digest") + F.octet_length("keep.file")
    joined = rows.join(small(repeated, width), "digest", "left")
    here = F.struct("id", "file", "position")
    members = settle(joined.filter("n IS NOT NULL").withColumn("keeper", here.eqNullSafe(F.col("keep")))
                     .select("digest", "file", "position", "size", "n", "keeper", "id", "keep"), "repeated-rows")
    different = settle(collisions(spark, path, text, members), "collisions")

    def result(rows: DataFrame) -> DataFrame:
        alone = F.col("n").isNull()
        return rows.select(
            F.col("id").alias(key), F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            (alone | here.eqNullSafe(F.col("keep"))).alias("kept"), "digest")

    if different.isEmpty():
        return result(joined)
    mixed = settle(_bodies(spark, path, text, members.join(small(different, 48), "digest", "left_semi").drop("n", "keep")), "mixed-texts")
    by_text = mixed.groupBy("digest", "text").agg(F.max(here).alias("keep"), F.count(F.lit(1)).alias("n"))
    apart = mixed.join(by_text, ["digest", "text"])
    return result(joined.join(small(different, 48), "digest", "left_anti")).unionAll(result(apart))
