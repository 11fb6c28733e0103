"""Rolling hashes of windows and a blocked Bloom filter over a string set (SEQ-2 with very large pattern sets).

The hash of ``c_0 .. c_n-1`` is ``sum (c_i + 1) P^i`` in 64 bits, so every window of a text costs one difference of
prefix sums and one product.  A filter is an array of 512-bit blocks; a hash picks a block and ``PROBES`` bits in
it.  A member always passes; of other strings about 1 in 100 at ``BITS`` bits a member.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, PROBES, WORDS = 12, 6, 8
MAX_BYTES = 256 << 20                     # a larger set gets fewer bits a member: more windows pass, none is lost
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class RollingHash:
    """Hashes of the windows of one text (bytes as they lie in memory)."""

    def __init__(self, text: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _powers(_P, len(text)), dtype=np.uint64)])
        self.back = _powers(_P_INVERSE, len(text) + 1)

    def of(self, starts: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        h = (self.sums[starts + n] - self.sums[starts]) * self.back[starts]
        return _mix(h + np.asarray(n, dtype=np.uint64))


def probes(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """``(word, bit mask)`` of the ``PROBES`` bits of each hash (probes x hashes)."""
    base = ((h >> np.uint64(11)) % np.uint64(blocks)).astype(np.int64) * WORDS
    g = _mix(h + np.uint64(1))
    bit = np.array([(g >> np.uint64(9 * i)) & np.uint64(511) for i in range(PROBES)])
    return base + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))


def passes(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    at, mask = probes(h, len(words) // WORDS)
    return ((words[at] & mask) != 0).all(0)


def build_filter(strings: DataFrame, column: str, count: int) -> np.ndarray:
    """The filter's words for ``count`` ASCII strings: bits OR-ed per task, then by word; its size is bounded by ``MAX_BYTES``."""
    blocks = max(1, min(math.ceil(count * BITS / 512), MAX_BYTES // 64))

    def to_bits(batches):
        for b in batches:
            s = b.column(0).cast(pa.large_binary())
            off = np.frombuffer(s.buffers()[1], np.int64)[s.offset:s.offset + len(s) + 1]
            if not len(s) or off[-1] == off[0]:
                continue
            text = np.frombuffer(s.buffers()[2], np.uint8)[off[0]:off[-1]]
            off = off - off[0]
            at, mask = probes(RollingHash(text).of(off[:-1], np.diff(off)), blocks)
            u, inv = np.unique(at.ravel(), return_inverse=True)
            bits = np.zeros(len(u), np.uint64)
            np.bitwise_or.at(bits, inv, mask.ravel())
            yield pa.record_batch([pa.array(u), pa.array(bits.view(np.int64))], names=["word", "bits"])

    got = strings.select(column).mapInArrow(to_bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(blocks * WORDS, np.uint64)
    words[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return words
