"""Shared pieces of the training-data operators: shared storage, Arrow views and hashing."""

from __future__ import annotations

import os
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    Read from spark.checkpoint.dir. Where that is unset, a local session (tests)
    uses a folder of this machine; on a cluster, whose machines would not see
    each other's, it is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
    return where or f"file://{os.path.join(tempfile.gettempdir(), 'tidewright-shared')}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as Parquet in the shared folder and read it back."""
    path = f"{shared_dir(df.sparkSession)}/tidewright-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, limit: str = "4m") -> None:
    """From now on the session hands rows to Python in batches of about `limit`, whatever their length.

    By default a batch has up to 10,000 rows, which are tens of MB of texts; a worker
    holds them going in and coming out, and so does its executor's JVM beside its
    heap. It holds for the session because a DataFrame that is returned runs later.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", limit)


def ship(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value of bounded size; calling the result on an executor gives the value."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """For functions of mapInArrow: a task that ends gives its memory back, since its worker lives on for later tasks."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes
        import gc

        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library: nothing to trim
            pass

    return wrapped


def in_fold(folds: int, part: int) -> Column:
    """Whether crc32 of doc_id's decimal text leaves this remainder; a null id is in no fold."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == part, F.lit(False))


def utf8_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, valid) of a string or binary Arrow array, without copying; a null has length 0."""
    n = len(column)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    valid = np.asarray(column.is_valid())
    return raw, off, valid


def spans_of(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut rows into runs [lo, hi) of about `limit` bytes each, one row at least."""
    lo, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64 (the splitmix64 constants)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX_1
        x = (x ^ (x >> np.uint64(27))) * MIX_2
        return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes modulo 2**64 of any substrings of a byte array, by prefix sums."""

    def __init__(self, seed: int = 7) -> None:
        self.byte = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self.base = int(mix64(np.array([seed + 99], np.uint64))[0]) | 1
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) >= n:
            return
        n = max(n, 2 * len(self.up))
        inverse = pow(self.base, -1, 2**64)
        for name, step in (("up", self.base), ("down", inverse)):
            powers = np.full(n, step, np.uint64)
            powers[0] = 1
            with np.errstate(over="ignore"):
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.byte[data] * self.up[: len(data)], out=out[1:], dtype=np.uint64)
        return out

    def between(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((prefix[end] - prefix[start]) * self.down[start])

    def windows(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all k-byte windows."""
        n = len(prefix) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            return mix64((prefix[k:] - prefix[:-k]) * self.down[: n - k + 1])


#: Bytes that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, everything else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in data; a word also ends where a text (starts) begins."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~SPACES[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    cut = starts[(starts > 0) & (starts < len(data))]
    begins[cut] |= word[cut]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:-1] = word[:-1] & ~word[1:]
    ends[-1] = word[-1]
    ends[cut] |= word[cut - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends)
