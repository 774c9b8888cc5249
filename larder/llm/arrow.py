"""Arrow batches in, Arrow batches out: how the operators run numpy work inside Spark tasks."""

from __future__ import annotations

import os
import pathlib
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from larder.session import configure

SLICE_BYTES = 2 << 20  # text handled at once inside a task
_shipped: list = []


def prepare(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small, so that a task's memory does not depend on how long texts are, and make sure
    that Python workers can import this package."""
    configure(spark)
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def _ship(spark: SparkSession) -> None:
    """Send the package to the workers, unless they find it through PYTHONPATH or have it installed."""
    root = pathlib.Path(__file__).resolve().parents[2]
    paths = [pathlib.Path(p or ".").resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    sc = spark.sparkContext
    if root in paths or root.name == "site-packages" or any(s is sc for s, _ in _shipped):
        return
    folder = tempfile.TemporaryDirectory()  # the driver serves the archive from here as long as the program runs
    _shipped.append((sc, folder))
    sc.addPyFile(shutil.make_archive(f"{folder.name}/larder", "zip", root, "larder"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose ``column`` holds about ``limit`` bytes (one row at least)."""
    for batch in batches:
        sizes = batch.column(column).fill_null("").cast(pa.large_string())
        _, offsets = text_buffers(sizes)
        start = 0
        for row in range(1, batch.num_rows + 1):
            if row == batch.num_rows or offsets[row + 1] - offsets[start] > limit:
                yield batch.slice(start, row - start)
                start = row


def text_buffers(texts: pa.Array):
    """UTF-8 bytes of an Arrow string column and the offsets of its rows; a null counts as an empty text."""
    import numpy as np

    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def with_field(schema: T.StructType, name: str, kind: str) -> T.StructType:
    """The schema with one more field of a type in DDL."""
    return T.StructType([*schema.fields, T.StructField(name, T.StructType.fromDDL(f"x {kind}")[0].dataType)])


def map_text(frame: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str | T.StructType,
             column: str = "text", setup: Callable[[], object] | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over runs of rows of about ``limit`` bytes of text.

    ``work(batch)``, or ``work(batch, state)`` with the result of ``setup()`` made once per task, returns a dict
    of columns in the order of ``schema``, or None for no rows.
    """
    spark = prepare(frame.sparkSession)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)

    def run(batches):
        state = [setup()] if setup else []
        for part in slices(batches, column, limit):
            out = work(part, *state)
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) and v.type == t.type else
                     v.cast(t.type) if isinstance(v, pa.Array) else pa.array(v, t.type)
                     for t, v in zip(arrow, out.values(), strict=True)], schema=arrow)
        state.clear()
        pa.default_memory_pool().release_unused()  # the worker process lives on and waits for other tasks

    return frame.mapInArrow(run, schema)


