"""Packing by order-preserving dynamic programming.

Documents keep their order (ascending id).  Their ids form one stream per shard
of the range-partitioned table, cut into windows of at most ``size`` ids at
candidate places: document ends (free), sentence ends and, inside stretches
longer than ``hard_step`` ids without either, places ``hard_step`` ids apart.  With
candidate places ``c`` and ``f(0) = 0``

    f(j) = min over c_j - c_i <= size of  f(i) + (size - (c_j - c_i)) + penalty(j)

padding and truncation penalties together are least.  The padding is linear in
``c_i``, so the minimum of ``f(i) + c_i`` over the sliding window sits at the head of a
monotone queue and every place is entered and left once.  The stream is solved
piece by piece as batches arrive; the last open window is carried on.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repflow.llm.encode import encoder, vocabulary
from repflow.llm.tables import n_slices
from repflow.llm.textkernel import runs, utf8

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def best_cuts(places: np.ndarray, penalty: np.ndarray, size: int) -> np.ndarray:
    """Indices into ``places`` (ascending, from 0, gaps of at most ``size``) of the chosen cuts, both ends included."""
    c, pen = places.tolist(), penalty.tolist()
    back = [0] * len(c)
    queue = deque([(0.0, 0)])                    # (f(i) + c_i, i), least first
    for j in range(1, len(c)):
        x = c[j]
        while x - c[queue[0][1]] > size:
            queue.popleft()
        v, i = queue[0]
        back[j] = i
        v += size + pen[j]                       # f(j) + c_j
        while queue and queue[-1][0] >= v:
            queue.pop()
        queue.append((v, j))
    cuts = [len(c) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return np.array(cuts[::-1])


def _candidates(doc_ends: np.ndarray, sentence_ends: np.ndarray, hard_step: int, sentence: float, hard: float):
    """Sorted candidate places from 0 on, with their penalties."""
    soft = np.unique(np.concatenate([[0], doc_ends, sentence_ends]))
    gap = np.diff(soft)
    extra = np.maximum((gap - 1) // hard_step, 0)
    inner = np.repeat(soft[:-1], extra) + hard_step * (
        np.arange(int(extra.sum())) - np.repeat(np.cumsum(extra) - extra, extra) + 1)
    places = np.concatenate([soft, inner])
    cost = np.concatenate([np.where(np.isin(soft, doc_ends), 0.0, sentence), np.full(len(inner), hard)])
    order = np.argsort(places, kind="stable")
    return places[order], cost[order]


class _Stream:
    """Open end of one shard's stream: ids, document spans ``(id, from, before, tokens)`` and sentence ends."""

    def __init__(self, size, sentence, hard, hard_step, shard):
        self.size, self.cost, self.step, self.next_id = size, (sentence, hard), hard_step, shard << 33
        self.ids, self.docs, self.ends = np.zeros(0, np.uint32), [], np.zeros(0, np.int64)

    def add(self, doc_ids, ids, bounds, ends):
        base = len(self.ids)
        n = np.diff(bounds)
        self.docs += [(d, base + int(b), 0, int(m)) for d, b, m in zip(doc_ids, bounds, n)]
        self.ids, self.ends = np.concatenate([self.ids, ids]), np.concatenate([self.ends, ends + base])

    def solve(self, last: bool) -> list[tuple]:
        """Finished pieces; unless ``last`` the final window stays open."""
        if not self.docs:
            return []
        doc_ends = np.array([x[1] for x in self.docs[1:]] + [len(self.ids)])
        places, cost = _candidates(doc_ends, self.ends, self.step, *self.cost)
        cuts = places[best_cuts(places, cost, self.size)]
        windows = len(cuts) - 1 if last else len(cuts) - 2
        out, raw, k = [], self.ids.astype("<u4").tobytes(), 0
        for w in range(windows):
            lo, hi = int(cuts[w]), int(cuts[w + 1])
            x = lo
            while x < hi:
                while int(doc_ends[k]) <= x:
                    k += 1
                d, at, before, total = self.docs[k]
                y = min(hi, int(doc_ends[k]))
                out.append((d, before + x - at, y - x, zlib.crc32(raw[4 * x:4 * y]), total, self.next_id, x - lo))
                x = y
            self.next_id += 1
        keep = int(cuts[windows])
        self.docs = [(d, max(at - keep, 0), before + max(keep - at, 0), n)
                     for (d, at, before, n), e in zip(self.docs, doc_ends) if e > keep]
        self.ids, self.ends = self.ids[keep:], self.ends[self.ends > keep] - keep
        return out


def pack(docs: DataFrame, vocab: str | None = None, size: int = 2048, end_id: int = 1, sentence_penalty: float = 4.0,
         hard_penalty: float = 12.0, hard_step: int = 64, shards: int | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    A document is its text's ids and then ``end_id`` (null and empty texts: that
    id alone).  Every id lies in exactly one piece; the pieces of a sequence
    follow one another from offset 0 and hold at most ``size`` ids.  Documents
    of one id stand next to each other in text order, null ids first; sequence ids ascend
    with the order.  An empty table gives no rows; other columns are ignored.
    """
    vocab = vocab or vocabulary("byte_bpe_50k.json")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.repartitionByRange(shards or n_slices(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    src = src.withColumn("shard", F.spark_partition_id())       # holds where one task runs several partitions

    def pack_shard(batches):
        enc = encoder(vocab)
        stream = None
        names = [f.split()[0] for f in SCHEMA.split(", ")]

        def rows(found):
            return pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * len(names))], names=names)

        for b in batches:
            if not b.num_rows:
                continue
            stream = stream or _Stream(size, sentence_penalty, hard_penalty, hard_step, b.column("shard")[0].as_py())
            buf, off = utf8(b.column("text"))
            doc_ids = b.column("doc_id").to_pylist()
            for i, j in runs(off):
                part, at = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                ids, starts, first = enc.encode(part, at)
                bound = first[np.searchsorted(starts, at)] if len(part) else np.zeros(len(at), np.int64)
                ids = np.insert(ids, bound[1:], np.uint32(end_id))
                inner = np.arange(j - i + 1)
                s = starts[1:-1] if len(starts) > 2 else np.zeros(0, np.int64)
                stop = np.isin(part[s - 1], np.frombuffer(b".!?", np.uint8)) | (part[s] == 10) if len(s) else np.zeros(0, bool)
                e = s[stop]
                ends = first[1:-1][stop] + np.searchsorted(at[1:], e, side="right") if len(s) else s
                stream.add(doc_ids[i:j], ids, bound + inner, ends)
                yield rows(stream.solve(False))
        if stream:
            yield rows(stream.solve(True))

    return src.mapInArrow(pack_shard, SCHEMA)
