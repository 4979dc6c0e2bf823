"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuecards.session import checkpoint_dir

#: Bytes of text one vectorised step handles; arrays of eight bytes a text byte stay small.
SEGMENT_BYTES = 1 << 20


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """At most ``rows`` rows in an Arrow batch while a job runs: a task then
    holds a few megabytes of text at a time on either side, not tens."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it
    back: lineage ends there, and a lost executor re-reads files."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    schema = df.schema
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_files(spark: SparkSession, path: str) -> None:
    """Delete a stage table that a newer one has replaced."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let the driver notice finished shuffles: their files go when the
    driver's handles are collected, which a long job may not see for a while."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have (case-insensitively)."""
    have = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in have:
        name += "_"
    return name


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its ``len + 1`` offsets into
    them; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_string())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset: col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def segments(off: np.ndarray, most: int = SEGMENT_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (a longer text is a range of its own)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, j
        i = j


def per_segment(fn: Callable[..., pa.RecordBatch | None], text: str, *carry: str,
                most: int = SEGMENT_BYTES) -> Callable:
    """A ``mapInArrow`` function: ``fn(data, offsets, {name: column})`` for
    each segment of each batch gives one output batch (or ``None``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_buffers(batch.column(text))
            for i, j in segments(off, most):
                out = fn(raw[off[i]: off[j]], off[i: j + 1] - off[i],
                         {c: batch.column(c).slice(i, j - i) for c in carry})
                if out is not None and out.num_rows:
                    yield out
    return run


def single_row_sum(df: DataFrame, expr) -> int:
    """A global sum as a driver scalar."""
    return int(df.agg(F.sum(expr)).first()[0] or 0)
