"""Text columns as numpy arrays: bytes, words, rolling hashes and sliding minima.

All hashes are fixed functions of the bytes, so every task and every retry computes the same ones.
They have 64 bits; two different strings share one with a probability of about 2^-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one value has one image."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_blocks(
    batches: Iterator[pa.RecordBatch],
    text: str = "text",
    limit: int = BLOCK_BYTES,
    most_rows: int = 4096,
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in blocks of about ``limit`` bytes of text: the rows, their UTF-8 bytes, the offsets.

    Blocks hold ``most_rows`` rows at most. A null text is empty. A text beyond the limit is a block of its own.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        lengths = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
            end = min(end, start + most_rows)
            rows = batch.slice(start, end - start)
            yield rows, *text_bytes(col.slice(start, end - start))
            start = end
    release_memory()


def release_memory() -> None:
    """Give freed memory back: workers live on between tasks, and share an executor's bound."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # a C library without it keeps what it has
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of every row; no word spans two rows."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = cuts[cuts > 0] - 1
    last[ends] = inside[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = BYTE_VALUES[data[np.repeat(starts, lengths) + at]] * powers[at]
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return _mixed(sums + lengths.astype(np.uint64))


def row_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row that each position lies in."""
    return np.searchsorted(offsets, positions, side="right") - 1


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive values, by doubling."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    done, size, power, out = 0, 1, _BASE, values
    result = None
    while True:
        if k & size:
            part = out[done : done + n]
            if result is None:
                result = part.copy()
            else:
                result = result * power + part
            done += size
        size *= 2
        if size > k:
            break
        out = out[: len(out) - size // 2] * power + out[size // 2 :]
        power = np.uint64(int(power) ** 2 % 2**64)
    return _mixed(result + np.uint64(k))


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` consecutive values."""
    size = 1
    while size * 2 <= w:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (w - size)], values[w - size :]) if w > size else values


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order. (Sorting is several times faster than hashing here.)"""
    x = np.sort(x)
    fresh = np.ones(len(x), bool)
    fresh[1:] = x[1:] != x[:-1]
    return x[fresh]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of lists from their values, one after the other, and how many each row has."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
