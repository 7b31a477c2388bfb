"""Columns of texts as numpy arrays of their UTF-8 bytes, and the words in them."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in groups of about so many bytes, which bounds the arrays of a task.
GROUP_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(20240613)
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C13
INVERSE = pow(BASE, -1, 2**64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


_LIBC = ctypes.CDLL(None) if sys.platform == "linux" else None


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task and waits beside others."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each number over all 64 (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(kind: str, base: int, n: int) -> np.ndarray:
    if len(_POWERS[kind]) < n:
        steps = np.full(max(n, GROUP_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _POWERS[kind] = np.cumprod(steps)
    return _POWERS[kind][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each text starts (one more entry for the end).
    A null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column) or starts[0] == starts[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0]:starts[-1]], starts - starts[0]


def groups(batches: Iterator[pa.RecordBatch], column: str = "text",
           size: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``size`` bytes of text; a longer text makes a slice alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every maximal run of bytes that are no white space, and the number of the
    first word of each text (one more entry for the end)."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    inside = ~SPACE[data]
    after = np.ones(n, bool)
    after[1:] = ~inside[:-1]
    begin = np.flatnonzero(inside & (after | edge[:n]))
    before = np.ones(n, bool)
    before[:-1] = ~inside[1:]
    end = np.flatnonzero(inside & (before | edge[1:])) + 1
    return begin, end, np.searchsorted(begin, starts)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, from prefix sums of a polynomial."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * _powers("up", BASE, len(data)), out=sums[1:])
    return mix((sums[end] - sums[begin]) * _powers("down", INVERSE, len(data) + 1)[begin])


def per_text(firsts: np.ndarray) -> np.ndarray:
    """Number of the text of each word, from the first word of each text."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
