"""Session settings the jobs are written for, and the folder their intermediate tables go to."""

import atexit
import os
import pathlib
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings; everything here can be set on a live session.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

_RUN = f"larder-{uuid.uuid4().hex}"
_roots: dict[str, SparkSession] = {}
_local: list[str] = []
settled: list[str] = []  # paths of the tables written by settle, in order


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


#: Bytes a task reads, and rows of the largest table a shuffle partition holds before adaptive execution joins small ones.
TASK_BYTES, TASK_ROWS = 16 << 20, 250_000


def bound_tasks(spark: SparkSession, rows: int) -> None:
    """Have the number of tasks, and not what one of them holds in memory, grow with the tables.

    Hash aggregation and sorting keep what a task reads. So files are read in pieces of TASK_BYTES at most, and shuffles
    of a table of ``rows`` rows start with a partition for each TASK_ROWS, never with fewer than the session asks for;
    adaptive execution joins them up to TASK_BYTES.
    """
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(TASK_BYTES))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, -(-rows // TASK_ROWS))))


_shipped: list = []


def ship_package(spark: SparkSession) -> SparkSession:
    """Make sure that Python workers can import this package: it is sent to them, once a session, unless they find it
    through PYTHONPATH or have it installed."""
    root = pathlib.Path(__file__).resolve().parents[1]
    paths = [pathlib.Path(p or ".").resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    sc = spark.sparkContext
    if root not in paths and root.name != "site-packages" and not any(s is sc for s, _ in _shipped):
        folder = tempfile.TemporaryDirectory()  # the driver serves the archive from here as long as the program runs
        _shipped.append((sc, folder))
        sc.addPyFile(shutil.make_archive(f"{folder.name}/larder-sales", "zip", root, "larder"))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder of this run's intermediate tables, removed when the program ends.

    It lies in the folder named by ``spark.checkpoint.dir``, which all executors share. Only a local master
    without that setting, as in tests, gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="larder-"))
        configured = _local[0]
    root = f"{configured.rstrip('/')}/{_RUN}"
    if not _roots:
        atexit.register(_clear)
    _roots[root] = spark
    return root


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete settled tables that no frame in use reads any more."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _clear() -> None:
    for root, spark in _roots.items():
        if spark.sparkContext._jsc is not None:  # the session may have been stopped before
            drop_tables(spark, [root])


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """Within, a write deletes its shuffle files when it ends, and not when the driver next collects garbage. Nothing
    reads them again, as a write is a plan of its own."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settle(frame: DataFrame, name: str = "frame") -> DataFrame:
    """Write a frame as a Parquet table into the run's folder and read it back.

    For tables that several later steps read, or where the lineage is to be cut. Readers take the columns and
    rows they need from the files, and a lost executor costs a re-read.
    """
    spark = frame.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_deleted(spark):
        frame.write.parquet(path)
    settled.append(path)
    return spark.read.schema(frame.schema).parquet(path)
