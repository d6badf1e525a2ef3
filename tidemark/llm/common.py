"""Shared helpers of the corpus operators: stored intermediates, Arrow text access, byte hashing."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: Bytes of text that one vectorised step works on; bounds the memory of a Python worker.
BLOCK_BYTES = 4 << 20
#: The same for the steps of the pipeline's stages, whose workers stay with what the stages before them left.
STEP_BYTES = 1 << 20

#: Bytes of an Arrow batch inside ``small_batches``; Spark's own bound is 64 MB, held on both sides.
BATCH_BYTES = 4 << 20

#: Odd multiplier of the rolling hash and its inverse modulo 2**64 (fixed values).
MULT = 0x9E3779B97F4A7C15
INVERSE = pow(MULT, -1, 1 << 64)
#: A second multiplier, for names of 128 bits (fixed value).
MULT2 = 0xD1342543DE82EF95


#: Spark's own switch that deletes a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's bound on the bytes of an Arrow batch.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage at a written table, so a lost executor costs a re-read and
    not a recomputation, and the columns keep one value for every later use.
    The shuffle files of the write go when it ends.  ``discard`` deletes the
    table when nothing reads it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    before = spark.conf.get(_CLEANUP, None)
    if before is not None:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is not None:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(schema).parquet(path)
    out._tidemark_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored``, on whatever file system they lie; frames that still read them fail from now on."""
    for df in tables:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._tidemark_path)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column without nulls, offsets starting at its own first row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, column.offset * 8)
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(buffers[2], np.uint8, last - first, first) if last > first else np.zeros(0, np.uint8)
    return data, offsets - first


def blocks(batch: pa.RecordBatch, text: int, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of text each (a longer row stands alone)."""
    _, offsets = text_buffers(batch.column(text))
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(n, max(start + 1, end))
        yield batch.slice(start, end - start)
        start = end


def give_back() -> None:
    """Return the memory that Arrow's and C's allocators keep for later to the operating system, where they can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not the GNU C library
        pass


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for a worker that serves many tasks: when one ends, what it freed is not held beside the next one's."""
    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


@contextmanager
def small_batches(spark, most: int = BATCH_BYTES) -> Iterator[None]:
    """What is computed inside exchanges Arrow batches of ``most`` bytes at most with Python (a larger row stands alone)."""
    before = spark.conf.get(_BATCH, None)  # None: not set, Spark's own holds
    spark.conf.set(_BATCH, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values (splitmix64)."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULT))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64, kept for later calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 2 * BLOCK_BYTES:
            _POWERS[base] = have
    return have[:n]


def prefix_hash(data: np.ndarray, base: int = MULT) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span of ``data``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers(base, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = MULT) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``, equal for equal bytes wherever they stand."""
    shift = powers(INVERSE if base == MULT else pow(base, -1, 1 << 64), len(prefix))
    return mix((prefix[ends] - prefix[starts]) * shift[starts] + (ends - starts).astype(np.uint64))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + length - 1`` of every pair, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - first, lengths)
