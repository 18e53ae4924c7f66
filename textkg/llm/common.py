"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space between words, as a regular expression for Java and RE2.
BLANKS = r"[\x20\x09-\x0D]+"

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def hand_back() -> None:
    """Give memory that Arrow's pool and the C library's heap hold unused back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def handing_back(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """`run`, a generator over the batches of a task, that leaves no free memory in its worker when it ends.

    Workers are used again, so what the allocators hold of earlier tasks and stages would add to what the JVM holds then.
    """

    @wraps(run)
    def wrapped(*args):
        try:
            yield from run(*args)
        finally:
            hand_back()

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def lower_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """The texts of a batch one by one; null is the empty text."""
    for value in batch.column(column):
        yield value.as_py() or ""


def byte_slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts have about `limit` bytes; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def utf8_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one array of bytes, and the bounds of each; null is the empty text."""
    binary = pc.fill_null(column.cast(pa.binary()).cast(pa.large_binary()), b"")
    _, offsets, data = binary.buffers()
    if not len(binary) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(binary) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def strings_of(raw: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The reverse of `utf8_of`."""
    buffers = [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(raw))]
    return pa.StringArray.from_buffers(len(bounds) - 1, *buffers[1:])
