"""Words and word shingles of a batch of texts, as numpy arrays over their UTF-8 bytes.

Lower case is for A-Z only and a word is a run of bytes outside ``[\\x20\\x09-\\x0D]``, so bytes of
other characters never matter. Hashes are 64 bits wide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_VALUE = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit value (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(count: int, _cache: list = [np.ones(1, dtype=np.uint64)]) -> np.ndarray:  # noqa: B006
    while len(_cache[0]) < count:
        step = np.uint64(pow(int(_BASE), len(_cache[0]), 1 << 64))
        _cache[0] = np.concatenate([_cache[0], _cache[0] * step])
    return _cache[0]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts (not copied), and where each text starts (one more than texts).
    Null: empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=width)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def cut(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    runs, first = [], 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        runs.append((first, last))
        first = last
    return runs


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words start (one more than texts)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    letters = LOWER[data[inside]]
    first = np.cumsum(inside)[starts] - 1  # place of each word's first byte among letters
    lengths = np.diff(np.append(first, len(letters)))
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    values = BYTE_VALUE[letters] * powers(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words; a shorter text has the
    whole sequence as its only one, a text without words none."""
    hashes, first = word_hashes(data, offsets)
    runs = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for k in range(width):
        runs += hashes[k:len(hashes) - width + 1 + k] * PLACE_VALUE[k]
    runs = mix(runs + PLACE_VALUE[width])
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(runs[a:b - width + 1]))
        elif b > a:
            short = (hashes[a:b] * PLACE_VALUE[:b - a]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mix(short + PLACE_VALUE[32 + b - a]))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
