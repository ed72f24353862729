"""Words of whole Arrow columns, found on their bytes.

Separators are ASCII bytes, which never occur inside another character of UTF-8, so a
column's bytes can be split without decoding them and without a Python object per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def byte_set(chars: bytes) -> np.ndarray:
    """Table over all byte values: is it one of ``chars``?"""
    table = np.zeros(256, bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return table


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is empty.  No copy but for 32-bit offsets."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def next_cut(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lo: int, size: int) -> int:
    """The first place from ``lo + size`` on that is a text's end or a separator."""
    hi, end = lo + size, int(offsets[-1])
    if hi >= end:
        return end
    nearest = int(offsets[np.searchsorted(offsets, hi)])     # the end of the text at hi
    while hi < nearest:
        found = np.flatnonzero(separators[data[hi:min(hi + 65_536, nearest)]])
        if len(found):
            return hi + int(found[0])
        hi = min(hi + 65_536, nearest)
    return hi


def chunks(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, size: int):
    """Byte ranges of about ``size`` that together cover the column; each ends at a text's end or before a
    separator, so no word is cut.  Only a word longer than ``size`` makes a longer range."""
    lo, end = int(offsets[0]), int(offsets[-1])
    while lo < end:
        hi = next_cut(data, offsets, separators, lo, size)
        yield lo, hi
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data[lo:hi]``; a word ends at a separator and at its text's end."""
    inside = ~separators[data[lo:hi]]
    limit = np.zeros(hi - lo + 1, bool)
    own = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi, "right")]
    limit[own - lo] = True
    limit[0] = limit[-1] = True
    begins = inside & limit[:-1]
    begins[1:] |= inside[1:] & ~inside[:-1]
    ends = inside & limit[1:]
    ends[:-1] |= inside[:-1] & ~inside[1:]
    return np.flatnonzero(begins) + lo, np.flatnonzero(ends) + lo + 1


def word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as one Arrow column of binary values."""
    if not len(starts):
        return pa.array([], pa.large_binary())
    lo, hi = int(starts[0]), int(ends[-1])
    step = np.zeros(hi - lo + 1, np.int8)
    step[starts - lo] = 1
    step[ends - lo] -= 1                     # one span may start where another ends
    kept = data[lo:hi][np.cumsum(step[:-1], dtype=np.int8).view(bool)]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
