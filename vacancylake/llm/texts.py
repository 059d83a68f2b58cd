"""What the text operators share: reading documents, words as numpy arrays, rolling hashes.

A word is a run of bytes other than space and the controls 9 to 13. These bytes
never occur inside a longer UTF-8 sequence, so words can be found on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]"
#: Rows of a batch are handled in slices of about this many text bytes, which bounds the arrays of a task.
SLICE_BYTES = 4 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of ``batch`` with about ``most`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    sizes = text_sizes(batch.column(batch.schema.get_field_index(text)))
    cut = np.cumsum(sizes) // most
    at = 0
    for end in [*(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]:
        if end > at:
            yield batch.slice(at, end - at)
            at = end


def _layout(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and the bytes they point into; nulls have no bytes."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return at, raw


def text_sizes(column: pa.Array) -> np.ndarray:
    return np.diff(_layout(column)[0]) if len(column) else np.zeros(0, np.int64)


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after another with a line break behind each, and where each starts.

    The second array has one more entry than there are texts.
    """
    at, raw = _layout(column)
    n = len(column)
    sizes = np.diff(at)
    starts = np.zeros(n + 1, np.int64)
    np.cumsum(sizes + 1, out=starts[1:])
    body = raw[at[0] : at[-1]] if n else raw[:0]
    out = np.insert(body, (at[1:] - at[0]), 10) if n else body
    return (_LOWER[out] if lower else out), starts


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums P and powers so that ``span_hash`` gives a 64-bit hash of any byte range in constant time."""
    n = len(data)
    powers = np.full(n, _MULTIPLIER, np.uint64)
    if n:
        powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers, out=sums[1:])
    inverse = np.full(n, _INVERSE, np.uint64)
    if n:
        inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    return sums, inverse


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of ``h`` over all bits (the finalizer of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def span_hash(sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of bytes [start, end) that depends on those bytes alone; empty ranges are not allowed."""
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


#: Sums modulo 2^64 tell short byte strings apart; longer ones can be built to agree, so they get another hash.
LONG_WORD = 256


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word [start, end), equal for equal words."""
    if not len(start):
        return np.zeros(0, np.uint64)
    sums, inverse = prefix_hashes(data)
    out = span_hash(sums, inverse, start, end)
    for k in np.flatnonzero(end - start > LONG_WORD).tolist():
        out[k] = xxhash.xxh64_intdigest(data[start[k] : end[k]].tobytes(), 7)
    return out


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in ``data``, which ends with a break."""
    space = _IS_SPACE[data]
    before = np.ones(len(space), bool)
    before[1:] = space[:-1]
    start = np.flatnonzero(before & ~space)
    end = np.flatnonzero(space & ~before)
    return start, end
