"""Word-shingle sets of whole texts as sorted 64-bit hashes, computed over many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_draw = np.random.default_rng(20240229)
_BYTE = _draw.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _draw.integers(1 << 63, size=16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_draw.integers(1 << 62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = []
TEXT_AT_ONCE = 1 << 20


def _powers_to(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64))])
                          for b in (_BASE, _INVERSE)]
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread over the whole 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about TEXT_AT_ONCE bytes; a longer text is a run of its own."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + TEXT_AT_ONCE, "right")) - 1)
        end = min(end, len(column))
        yield row, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and how many words stand before each text."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_WHITE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # a word never crosses into the next text
    starts = np.flatnonzero(inside & (first[:n] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (first[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    up, down = _powers_to(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[_LOWER[data]] * up[:n])])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles; a shorter text is one shingle, an empty one has none."""
    for _, data, offsets in pieces(column):
        hashes, at = words(data, offsets)
        total = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
        for j in range(k):
            total += hashes[j: j + len(total)] * _PLACE[j]
        rolling = mixed(total)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= k:
                s = np.sort(rolling[a: b - k + 1])
                yield s[np.concatenate([[True], s[1:] != s[:-1]])]
            elif b > a:
                short = (hashes[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True) + _PLACE[k + b - a]
                yield mixed(short)
            else:
                yield np.zeros(0, np.uint64)
