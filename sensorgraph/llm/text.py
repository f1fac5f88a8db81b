"""Small NumPy helpers for tasks that read text columns as Arrow batches.

Texts of a batch are looked at as one byte array with offsets, so that words and their hashes are found without
a Python object per word. Nothing here knows Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
#: Bytes hashed at once. Each worker holds two tables of powers for twice as many, 8 bytes each.
HASH_BYTES = 1 << 17
_MULTIPLIER = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NOT_WHITE = ~WHITE
#: Digits, letters and every byte of a character outside ASCII.
WORD_CHARS = np.zeros(256, bool)
WORD_CHARS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_BYTE_CODES = np.random.default_rng(20240917).integers(0, 1 << 64, 256, dtype=np.uint64)


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column; null counts as empty."""
    values = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(ends):
        ends = np.zeros(1, np.int64)
    return data[ends[0] : ends[-1]], ends - ends[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most`` bytes; a longer text is alone."""
    first, count = 0, len(offsets) - 1
    while first < count:
        after = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        after = min(max(after, first + 1), count)
        yield first, after
        first = after


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes of a class, and per text its range of runs."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    here = inside[data]
    before = np.concatenate(([False], here[:-1]))
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.concatenate((here[1:], [False]))
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(here & ~before)
    return starts, np.flatnonzero(here & ~after) + 1, np.searchsorted(starts, offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = powers(_MULTIPLIER, HASH_BYTES * 2), powers(_INVERSE, HASH_BYTES * 2)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the spans being in order of their starts."""
    codes = _BYTE_CODES[LOWER] if lower else _BYTE_CODES
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        after = int(np.searchsorted(starts, low + HASH_BYTES, "left"))
        high = int(ends[first:after].max())
        if high - low > len(_UP) - 1:  # a single huge word
            up, down = powers(_MULTIPLIER, high - low + 1), powers(_INVERSE, high - low + 1)
        else:
            up, down = _UP, _DOWN
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(codes[data[low:high]] * up[: high - low], out=total[1:])
        a, b = starts[first:after] - low, ends[first:after] - low
        out[first:after] = (total[b] - total[a]) * down[a] + (b - a).astype(np.uint64)
        first = after
    return mixed(out)


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive values."""
    count = max(0, len(values) - width + 1)
    out = np.zeros(count, np.uint64)
    for k in range(width):
        out = out * np.uint64(_MULTIPLIER) + values[k : k + count]
    return mixed(out + np.uint64(width))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
