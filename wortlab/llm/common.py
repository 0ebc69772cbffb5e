"""Helpers shared by the operators: input columns, written intermediate tables, and words as numpy arrays.

Words of a block of texts are held as byte ranges of one buffer, and per-word 64-bit hashes come from numpy, so that no
Python object is made per word.  A block is a few whole documents (one, if it is very long): memory is bounded by the
block size plus one document.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_ready, scratch_path
from .shared_files import resolve

BLOCK_BYTES, SLICE_BYTES = 1 << 20, 1 << 17
U64 = np.uint64


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    ensure_ready(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


_MADE: list[str] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder, removed when this program ends."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    _MADE.append(path)
    return path


@atexit.register
def _clear() -> None:
    for path in _MADE:
        fs, place = resolve(path)
        with contextlib.suppress(OSError):  # a folder that was never written
            fs.delete_dir(place)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, read by any executor, no lineage behind it."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; after the last one, memory that the worker process holds but does not use goes back."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not glibc
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def blocks(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``max_bytes`` of text each, as (rows, UTF-8 bytes, offsets from 0); null is empty."""
    for batch in released(batches):
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary()).fill_null(b"")
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(col):
            j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
            yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


#: Words are runs of bytes outside space, tab and \n to \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words of a block: ``start`` and ``end`` bytes, and ``first[d]``, the number of words before document d."""

    def __init__(self, data: np.ndarray, off: np.ndarray, separator: np.ndarray = SPACE):
        inside = ~separator[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        begins = inside & (~before | edge[:-1])
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, off)
        self.data, self.inside, self.begins = data, inside, begins
        self.n = len(self.start)

    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: random values for (byte, place in the word), added up and mixed."""
        out = np.zeros(self.n, U64)
        i = 0
        while i < self.n:  # some words at a time: the numbers below take many times the bytes of the words
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + SLICE_BYTES)))
            low, high = int(self.start[i]), int(self.end[j - 1])
            at = np.flatnonzero(self.inside[low:high])
            word = np.cumsum(self.begins[low:high], dtype=np.int32)[at] - 1
            place = at - (self.start[i:j] - low)[word]
            values = _TABLE[((place & 63) << 8) | self.data[low:high][at]]
            if place.max() > 63:
                values = values * (((place >> 6).astype(U64) * U64(0x9E3779B97F4A7C15)) + U64(1))
            out[i:j] = mix(np.add.reduceat(values, np.searchsorted(at, self.start[i:j] - low)))
            i = j
        return out


_TABLE = np.random.default_rng(20240607).integers(0, 1 << 64, 64 * 256, dtype=U64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def grams(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of every run of ``k`` hashes in ``h`` (length n - k + 1; runs may cross documents, callers mask those)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    m = U64(seed * 2 + 1)
    out = np.zeros(n, U64)
    for j in range(k):
        out = out * m + h[j:j + n]
    return mix(out)


def sliding_argmin(x: np.ndarray, w: int) -> np.ndarray:
    """Place of the leftmost minimum of every ``w`` consecutive values."""
    span, at, least = 1, np.arange(len(x)), x
    while span < w and len(at):
        step = min(span, w - span)
        right = least[step:] < least[:-step]
        at, least = np.where(right, at[step:], at[:-step]), np.where(right, least[step:], least[:-step])
        span += step
    return at


def covered(n: int, start: np.ndarray, length) -> np.ndarray:
    """True at each of ``n`` places inside one of the ranges [start, start + length)."""
    edge = np.bincount(start, minlength=n + 1)[:n + 1].astype(np.int64)
    edge -= np.bincount(np.minimum(start + length, n), minlength=n + 1)[:n + 1]
    return np.cumsum(edge[:n]) > 0
