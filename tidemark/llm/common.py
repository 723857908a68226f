"""Helpers shared by the operators: scratch tables, Arrow batches, text buffers."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

#: Bounds of the Arrow batches that Python tasks receive (rows and bytes).
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20
#: Bytes of text that one vectorised pass works on (its temporaries are a few tens of times larger).
SLICE_BYTES = 1 << 20


def prepare(spark: SparkSession) -> str:
    """The shared scratch folder; bounds Arrow batches unless the submitter has set them."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                       ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if key not in _submitted(spark):
            spark.conf.set(key, str(value))
    ship_package(spark)
    return ensure_checkpoint_dir(spark)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: Spark hands out a zip of its sources, once."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-src-"), "tidemark_sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._tidemark_shipped = True


def _submitted(spark: SparkSession) -> set[str]:
    return {k for k, _ in spark.sparkContext.getConf().getAll()}


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared scratch folder and read it back.

    The table lives under ``spark.checkpoint.dir``, so it survives lost
    executors; what reads it never recomputes ``df``. The application's folder
    there is removed when the application ends.
    """
    spark = df.sparkSession
    root = prepare(spark)
    folder = f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _remove_at_end(spark, folder)
    return spark.read.schema(df.schema).parquet(path)


def _remove_at_end(spark: SparkSession, folder: str) -> None:
    sc = spark.sparkContext
    if not getattr(sc, "_tidemark_scratch", False):
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
        sc._tidemark_scratch = True


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, a function of a Python task over Arrow batches; at the task's end the worker gives back the memory that is free.

    Workers are reused: what their allocators keep after a task is held beside the JVM while later
    stages run, in the stages without Python too."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


def release_memory() -> None:
    """Give what Arrow's pool and the C library hold unused back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(_C, "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


_C = ctypes.CDLL(None)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without Python objects; null is the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of about ``most`` bytes each; one longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
