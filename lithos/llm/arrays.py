"""Words, hashes and sets of many texts at once, as numpy arrays over Arrow buffers.

These helpers run inside Spark tasks, on slices of an Arrow batch of about a quarter of a megabyte,
so their memory doesn't depend on the batch; one longer text makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words that end at anything but ASCII letters, digits and non-ASCII characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[data]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), in a new array."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(7919))
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base & _MASK, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[:] = out
    return _powers[0], _powers[1]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, byte offsets) of slices of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        kind = np.int32
    else:
        kind = np.int64
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * np.dtype(kind).itemsize)
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    if column.null_count:
        lengths = np.diff(offsets) * column.is_valid().to_numpy(zero_copy_only=False)
        if (lengths != np.diff(offsets)).any():  # a null that covers bytes
            return (yield from text_slices(column.fill_null("" if "string" in str(column.type) else b""), limit))
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, len(column))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of bytes that ``kind`` holds, within a text), and each text's first word."""
    n = len(data)
    inside = kind[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z in lower case."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total *= np.uint64(_BASE)
        total += words[i : i + n]
    return mixed(total + np.uint64(k))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - at, lengths)
