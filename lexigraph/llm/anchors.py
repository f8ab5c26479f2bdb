"""Content-defined keys of fixed-length byte strings.

The key of a `length`-byte string is the least hash of the `gram`-byte substrings inside it. It depends on
the string alone, so equal strings in different texts have equal keys: strings can be dealt by key, and a
string whose key occurs in one text only occurs in one text only. Neighbouring strings mostly share their
key, so a text falls into segments of strings of one key, about (length - gram + 2) / 2 strings each.
"""

from __future__ import annotations

import numpy as np

from .common import mixed

GRAM = 20


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of data[i : i + gram] for each i (8 <= gram <= 24)."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data),), np.uint64, padded.data, 0, (1,))
    h = eight[:n] * np.uint64(0x9E3779B97F4A7C15)
    if gram > 16:
        h ^= h >> np.uint64(29)
        h += eight[8 : 8 + n]
        h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h += eight[gram - 8 : gram - 8 + n]
    return mixed(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i : i + width] for each i, by doubling."""
    out, size = x, 1
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    if size < width:
        out = np.minimum(out[: len(out) - (width - size)], out[width - size :])
    return out


def segments(data: np.ndarray, ends: np.ndarray, length: int = 50, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts one after another in data (bounded by ends): (key, text, first, last) of each segment, in order:
    the strings that start at first .. last, all of one key. Strings never cross texts."""
    low = sliding_min(gram_hashes(data, gram), length - gram + 1)[: max(0, len(data) - length + 1)]
    size = np.diff(ends)
    full = np.flatnonzero(size >= length)
    if not len(full) or not len(low):
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    edge = np.zeros(len(data) + 1, np.int8)
    edge[ends[full]] += 1
    edge[ends[full] + size[full] - length + 1] -= 1
    start = np.flatnonzero(np.cumsum(edge[: len(low)], dtype=np.int8) > 0)
    key = low[start]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (start[1:] != start[:-1] + 1)])
    head = np.flatnonzero(new)
    first = start[head]
    last = start[np.concatenate([head[1:], [len(start)]]) - 1]
    return key[head], np.searchsorted(ends, first, "right") - 1, first, last
