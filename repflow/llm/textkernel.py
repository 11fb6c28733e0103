"""Vectorised text arithmetic over Arrow batches (numpy on the UTF-8 buffer, whole texts only).

Spark partitions and moves the rows; these helpers cut one batch into words,
hash them and build shingle sets, without a Python loop over characters.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P = np.uint64(0x9E3779B97F4A7C15)
_POW = np.ones(1, dtype=np.uint64)


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_binary()) if pa.types.is_binary(arr.type) else arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_large_binary(arr.type) else "")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, max_bytes: int = 1 << 20):
    """Document ranges ``(i, j)`` of at most ``max_bytes`` bytes (a longer document stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    global _POW
    if len(_POW) < n:
        _POW = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 64) * 2 - 1, _P, np.uint64)]), dtype=np.uint64)
    return _POW


def segment_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``buf[start:end]`` (ascending, disjoint, non-empty segments)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    if int(length.sum()) == len(buf) and starts[0] == 0 and np.array_equal(ends[:-1], starts[1:]):
        flat, first = buf, starts
    else:
        first = np.concatenate([[0], np.cumsum(length)[:-1]])
        flat = buf[np.arange(int(length.sum())) + np.repeat(starts - first, length)]
    pos = np.arange(len(flat)) - np.repeat(first, length)
    v = (flat.astype(np.uint64) + np.uint64(1)) * _powers(int(length.max()))[pos]
    return mix(np.add.reduceat(v, first) ^ (length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def words(buf: np.ndarray, offsets: np.ndarray, solid_bytes: np.ndarray = ~SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: bounds of the runs of ``solid_bytes``, and per document the index of its first (n + 1 entries)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = solid_bytes[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True                     # documents never share a word
    before = np.concatenate([[False], solid[:-1]])
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.concatenate([solid[1:], [False]])
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words and each document's first word index."""
    starts, ends, first = words(buf, offsets)
    return segment_hash(LOWER[buf], starts, ends), first


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its ``k``-word shingles (fewer words: the whole sequence)."""
    h, first = word_hashes(buf, offsets)
    mult = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    roll = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        roll += h[j:len(h) - k + 1 + j] * mult[j]
    roll = mix(roll)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= k:
            s = np.sort(roll[a:b - k + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            out.append(mix((h[a:b] * mult[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()
