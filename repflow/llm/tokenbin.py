"""Token-ID shards with a minimal perfect hash index.

Layout of a shard file (little endian; one section after the other):

    header    magic "RFTB", version u32, documents u64, ids u64, id bytes u32, levels u32, hash seed u32
    levels    bits of each level u64
    bitmap    the levels' bits, u64 words
    ranks     set bits before each word, u32
    slots     fingerprint u32, first id u64, id count u64   (by hash slot)
    keys      document id i64, flag u8 (1: null), occurrence u32  (in order)
    payload   raw ids, u16 or u32, documents in order

The index is built level by level: a key whose hash position in a level is its
own is settled there, the others go to the next, smaller level; the rank of
a key's bit among all bits is its slot, so ``n`` keys fill exactly ``n`` slots.
Keys that share a hash, or that ``MAX_LEVELS`` levels do not settle, get another hash seed.
A lookup costs a few hashes and one rank, a fingerprint rejects foreign keys.

Shards are written by the tasks of a range-partitioned, sorted table straight to
the shared folder (any filesystem that pyarrow knows), under their final name
only when complete; a repeated task writes the same bytes again.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repflow.llm.encode import encoder, vocabulary
from repflow.llm.tables import n_slices, scratch, stored
from repflow.llm.textkernel import mix, runs, utf8

MAGIC, VERSION = b"RFTB", 2
MAX_LEVELS, MAX_SEEDS = 64, 16
HEAD = np.dtype([("magic", "S4"), ("version", "<u4"), ("docs", "<u8"), ("ids", "<u8"), ("width", "<u4"), ("levels", "<u4"), ("seed", "<u4")])
SLOT = np.dtype([("fingerprint", "<u4"), ("first", "<u8"), ("n", "<u8")])
KEY = np.dtype([("id", "<i8"), ("null", "u1"), ("occurrence", "<u4")])
MANIFEST = "path string, part int, nth int, n_docs long, n_ids long"


def key_hash(keys: np.ndarray, seed: int = 0) -> np.ndarray:
    h = mix(keys["id"].astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) % 2**64))
    return mix(h ^ mix(keys["occurrence"].astype(np.uint64) * np.uint64(2) + keys["null"].astype(np.uint64)))


def _positions(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    seed = mix(np.array([level + 1], np.uint64))
    return (mix(h + seed) % np.uint64(bits)).astype(np.int64)


def build_index(h: np.ndarray, gamma: float = 1.7) -> tuple[list[int], np.ndarray, np.ndarray]:
    """``(level sizes, bitmap words, ranks)`` of a minimal perfect hash of 64-bit hashes; ValueError if ``MAX_LEVELS`` do not settle them."""
    sizes, words, left = [], [], h
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("hashes of an index repeat")
        bits = (int(len(left) * gamma) // 64 + 1) * 64
        p = _positions(left, len(sizes), bits)
        alone = np.bincount(p, minlength=bits) == 1
        sizes.append(bits)
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        left = left[~alone[p]]
    bitmap = np.concatenate(words) if words else np.zeros(0, "<u8")
    ones = np.bitwise_count(bitmap).astype(np.int64)
    return sizes, bitmap, (np.cumsum(ones) - ones).astype("<u4")


def find_slots(h: np.ndarray, sizes: list[int], bitmap: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Slot of each hash (-1 when no level settles it)."""
    slot, open_, base = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
    for level, bits in enumerate(sizes):
        p = base + _positions(h[open_], level, bits)
        w, bit = p >> 6, (p & 63).astype(np.uint64)
        hit = (bitmap[w] >> bit) & np.uint64(1) == 1
        below = bitmap[w[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
        slot[open_[hit]] = ranks[w[hit]].astype(np.int64) + np.bitwise_count(below)
        open_, base = open_[~hit], base + bits
    return slot


def to_bytes(keys: np.ndarray, counts: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    for seed in range(MAX_SEEDS):
        h = key_hash(keys, seed)
        try:
            sizes, bitmap, ranks = build_index(h)
            break
        except ValueError:                       # two keys of one hash: another seed tells them apart
            if seed == MAX_SEEDS - 1:
                raise
    slots = np.zeros(len(keys), SLOT)
    at = find_slots(h, sizes, bitmap, ranks)
    slots["fingerprint"][at] = (h >> np.uint64(32)).astype("<u4")
    slots["first"][at] = np.cumsum(counts) - counts
    slots["n"][at] = counts
    head = np.array([(MAGIC, VERSION, len(keys), len(ids), width, len(sizes), seed)], HEAD)
    return b"".join(x.tobytes() for x in (head, np.array(sizes, "<u8"), bitmap, ranks, slots, keys, ids.astype(f"<u{width}")))


class Shard:
    """A shard read back: ``keys``, and ``get(keys)`` for constant-time access."""

    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0
        head = self._take(HEAD, 1)[0]
        if head["magic"] != MAGIC or head["version"] != VERSION:
            raise ValueError("not a token shard")
        n, self.seed = int(head["docs"]), int(head["seed"])
        self.sizes = [int(x) for x in self._take(np.dtype("<u8"), int(head["levels"]))]
        self.bitmap = self._take(np.dtype("<u8"), sum(self.sizes) // 64)
        self.ranks = self._take(np.dtype("<u4"), len(self.bitmap))
        self.slots, self.keys = self._take(SLOT, n), self._take(KEY, n)
        self.ids = self._take(np.dtype(f"<u{int(head['width'])}"), int(head["ids"]))

    def _take(self, dtype: np.dtype, n: int) -> np.ndarray:
        out = np.frombuffer(self.raw, dtype, n, self.at)
        self.at += n * dtype.itemsize
        return out

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(found, first id, id count)`` of each key."""
        h = key_hash(keys, self.seed)
        slot = find_slots(h, self.sizes, self.bitmap, self.ranks)
        s = self.slots[np.maximum(slot, 0)] if len(self.slots) else np.zeros(len(h), SLOT)
        found = (slot >= 0) & (s["fingerprint"] == (h >> np.uint64(32)).astype("<u4"))
        return found, s["first"].astype(np.int64), s["n"].astype(np.int64)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_shards(docs: DataFrame, path: str, vocab: str, end_id: int, shard_ids: int = 4_000_000, shards: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards under ``path`` in ascending id order; the stored manifest has one row per file."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.repartitionByRange(shards or n_slices(docs), "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches):
        enc = encoder(vocab)
        width = 2 if max(enc.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else 4
        store, root = _open(path)
        store.create_dir(root, recursive=True)
        part, nth, keys, counts, ids = TaskContext.get().partitionId(), 0, [], [], []
        last, seen = object(), 0

        def flush():
            nonlocal nth, keys, counts, ids
            n, flat = np.concatenate(counts), np.concatenate(ids)
            name = f"{root}/shard-{part:06d}-{nth:06d}.bin"
            part_name = f"{name}.{uuid.uuid4().hex}.part"
            with store.open_output_stream(part_name) as out:
                out.write(to_bytes(np.array(keys, KEY), n, flat, width))
            store.move(part_name, name)
            row = pa.record_batch([[name], pa.array([part], pa.int32()), pa.array([nth], pa.int32()), [len(keys)], [len(flat)]],
                                  names=["path", "part", "nth", "n_docs", "n_ids"])
            nth, keys, counts, ids = nth + 1, [], [], []
            return row

        for b in batches:
            buf, off = utf8(b.column("text"))
            doc_ids = b.column("doc_id").to_pylist()
            for i, j in runs(off):
                part_buf, at = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                got, starts, first = enc.encode(part_buf, at)
                bound = first[np.searchsorted(starts, at)] if len(part_buf) else np.zeros(len(at), np.int64)
                ids.append(np.insert(got, bound[1:], np.uint32(end_id)))
                counts.append(np.diff(bound) + 1)
                for d in doc_ids[i:j]:
                    seen = seen + 1 if d == last else 0
                    last = d
                    keys.append((d or 0, d is None, seen))
                if sum(map(len, ids)) >= shard_ids:
                    yield flush()
        if keys:
            yield flush()

    return stored(src.mapInArrow(write, MANIFEST), "manifest")


def read_shards(manifest: DataFrame, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, each fetched by key from its shard.

    ``start`` counts the ids of all documents before it; only the manifest (one
    small row per file) is put in one order for that.
    """
    order = Window.orderBy("part", "nth")
    files = manifest.withColumn("before", F.sum("n_ids").over(order) - F.col("n_ids")).select("path", "before")
    files = files.repartition(n_slices(manifest), "path")

    def read(batches):
        store, _ = _open(path)
        for b in batches:
            for p, before in zip(b.column("path").to_pylist(), b.column("before").to_pylist()):
                with store.open_input_stream(p) as f:
                    shard = Shard(f.read())
                found, first, n = shard.get(shard.keys)
                if not found.all():
                    raise ValueError(f"{p}: a key is not in its own index")
                crc = [zlib.crc32(shard.ids[s:s + m].astype("<u4").tobytes()) for s, m in zip(first.tolist(), n.tolist())]
                yield pa.record_batch([pa.array(shard.keys["id"], pa.int64(), mask=shard.keys["null"] > 0), pa.array(before + first),
                                       pa.array(n), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_shards(docs: DataFrame, vocab: str | None = None, end_id: int = 2, path: str | None = None, **kw) -> DataFrame:
    """Write all documents as shards and read them back: ``(doc_id, start, n_tokens, ids_crc32)``.

    Null and empty texts are the end id alone; null ids come first; rows of one
    id are told apart by their occurrence, in text order.  An empty table
    writes no file and gives no rows; other columns are ignored.
    """
    path = path or scratch(docs.sparkSession, "tokens")
    return read_shards(write_shards(docs, path, vocab or vocabulary("word_bpe_49k.json"), end_id, **kw), path)
