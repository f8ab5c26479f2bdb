"""What the training-data operators share: table access, shared storage and byte-level kernels.

The kernels work on one Arrow batch at a time, on the UTF-8 bytes that Spark hands over, so that a
batch of documents costs a fixed number of numpy passes instead of Python work for each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import cut, shared_dir, table, written  # noqa: F401  the operators take them from here

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Odd multiplier of the word hash; any odd number does.
WORD_BASE = 0x9E3779B97F4A7C15


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most this many rows, so that long texts don't fill a Python worker."""
    for key in ("spark.sql.execution.arrow.maxRecordsPerBatch",):
        if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
            spark.conf.set(key, str(rows))


def identified(df: DataFrame, *columns: str, key: str = "doc_id") -> DataFrame:
    """The named columns of the rows that have a key; extra columns, whatever their names, stay behind."""
    return df.select(key, *columns).where(F.col(key).isNotNull())


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after another, offsets of n + 1 ends); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    held = np.frombuffer(data, np.uint8, ends[-1] - ends[0], ends[0]) if data is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return held, ends - ends[0]


def in_blocks(batches: Iterator[pa.RecordBatch], most: int = 1 << 22, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of text, at least one row each."""
    for batch in batches:
        ends = text_bytes(batch.column(batch.schema.get_field_index(text)))[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), elementwise."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int = WORD_BASE) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of each word `[^\\x20\\x09-\\x0D]+`; words never cross documents."""
    solid = ~SPACE[data]
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = ends[1:-1][ends[1:-1] < len(data)]
    first[inner] |= solid[inner]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    before = inner[inner > 0] - 1
    last[before] |= solid[before]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(ends, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over the word, then mixed with its length."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = (end - start).astype(np.int64)
    at = np.arange(int(length.sum()), dtype=np.int64)
    began = np.cumsum(length) - length
    within = at - np.repeat(began, length)
    value = data[np.repeat(start, length) + within].astype(np.uint64) + np.uint64(1)
    value *= powers(int(length.max()))[within]
    return mixed(np.add.reduceat(value, began) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
