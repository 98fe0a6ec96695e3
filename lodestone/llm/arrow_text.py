"""Zero-copy views of Arrow text columns for the Arrow-backed operators.

A text column of a record batch is a UTF-8 buffer plus offsets, so whole documents can be scanned with
numpy without making a Python string for each.  ``slices`` bounds the working memory: it hands out runs of rows
of at most ``max_bytes`` of text (a longer document comes alone), so peak memory follows the slice, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def utf8_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of the column, row offsets, validity); a null row has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offset_buf, data_buf = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, bool)
    offsets = np.frombuffer(offset_buf, np.int32, count=n + 1, offset=4 * column.offset).astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    valid = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else np.ones(n, bool)
    return data, offsets, valid


def row_runs(offsets: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) with at most ``max_bytes`` of text each, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def slices(column: pa.Array, max_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0, validity) for each run of rows."""
    data, offsets, valid = utf8_view(column)
    for lo, hi in row_runs(offsets, max_bytes):
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], valid[lo:hi]


def ragged_take(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of flat[starts[i] : starts[i] + lengths[i]]."""
    total = int(lengths.sum())
    if total == 0:
        return flat[:0]
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return flat[shift + np.arange(total)]


_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of 64-bit words."""
    with np.errstate(over="ignore"):
        z = np.asarray(x, np.uint64) + _MIX[0]
        z = (z ^ (z >> np.uint64(30))) * _MIX[1]
        z = (z ^ (z >> np.uint64(27))) * _MIX[2]
        return z ^ (z >> np.uint64(31))
