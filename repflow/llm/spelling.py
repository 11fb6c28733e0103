"""Spelling variants: words one edit apart, by asymmetric chunks.

Of two words at most one edit apart, the shorter one (of ``L`` code points) is cut into two
disjoint chunks, ``[0, q)`` and ``[q, L)`` with ``q = L // 2``.  One edit leaves one of them
unchanged, and the longer word holds it as a positional gram: at the same place, or, behind an
inserted code point, one place on.  So the longer word gives its grams at the places that a
chunk can reach within shift one, and equality of (chunk number, ``L``, gram) joins the two sides.

A chunk that many words share would meet the square of its words.  Of the rest of the word,
one half again is unchanged, so every key also holds one half of the rest; this keeps
frequent prefixes and endings from meeting as a whole.  Whatever meets is verified.

Every pair meets under exactly one key that counts: the first of its keys in a fixed order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repflow.llm.encode import LETTER
from repflow.llm.tables import stored
from repflow.llm.textkernel import LOWER, runs, segment_hash, utf8

RUN_BYTES = 8 << 20
FLUSH_BYTES = 48 << 20
LONG = 48                                  # longer runs are checksummed one by one, longer words compared in linear time
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def letter_runs(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)`` of the maximal runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, per document."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    lead = buf == 0xC3                      # the block's two-byte characters
    solid = LETTER[buf] | lead
    solid[1:] |= lead[:-1]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[off] = True
    starts = np.flatnonzero(solid & (~np.concatenate([[False], solid[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(solid & (~np.concatenate([solid[1:], [False]]) | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def checksums(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of each ``buf[start:end]``, continued from ``state`` (the crc32 of what stands before it)."""
    size = ends - starts
    out = np.zeros(len(starts), np.uint32)
    short = np.flatnonzero(size <= LONG)
    order = short[np.argsort(-size[short], kind="stable")]
    crc, at, n = ~state[order], starts[order], size[order]
    for j in range(int(n[0]) if len(n) else 0):
        k = int(np.searchsorted(-n, -j, side="left"))         # the runs longer than j bytes
        crc[:k] = _CRC[(crc[:k] ^ buf[at[:k] + j]) & 255] ^ (crc[:k] >> 8)
    out[order] = ~crc
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = zlib.crc32(buf[starts[i]:ends[i]].tobytes(), int(state[i]))
    return out


def counted(buf: np.ndarray, off: np.ndarray, ids: list[str | None], every: int, least_length: int):
    """``(words as Arrow strings, counts)`` of a batch; words shorter than ``least_length`` are left out."""
    buf = LOWER[buf]
    starts, ends, first = letter_runs(buf, off)
    if not len(starts):
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    state = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = checksums(buf, starts, ends, np.repeat(state, np.diff(first)))
    more = np.concatenate([[0], np.cumsum((buf & 0xC0) == 0x80)])
    length = (ends - starts) - (more[ends] - more[starts])
    changed, changes = h % np.uint32(every) == 0, []
    for i in np.flatnonzero(changed & (length > least_length)).tolist():
        run = buf[starts[i]:ends[i]].tobytes().decode()
        k = int(h[i]) % len(run)
        changes.append(run[:k] + run[k + 1:])
    kept = np.flatnonzero(~changed & (length >= least_length))
    s, e = starts[kept], ends[kept]
    _, one, n = np.unique(segment_hash(buf, s, e), return_index=True, return_counts=True)
    one_s, size = s[one], e[one] - s[one]
    to = np.concatenate([[0], np.cumsum(size)])
    flat = buf[np.arange(int(to[-1])) + np.repeat(one_s - to[:-1], size)]
    words = pa.LargeStringArray.from_buffers(len(one), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(flat)).cast(pa.string())
    return (pa.concat_arrays([words, pa.array(changes, pa.string())]),
            np.concatenate([n, np.ones(len(changes), np.int64)]))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199,
                least_length: int = 6, least_count: int = 5) -> DataFrame:
    """``(word, n)``: occurrences over all whole texts of words with at least that length and count.

    Words are the maximal runs of Latin letters, A-Z lower-cased; where ``every`` divides the crc32 of
    ``<id>:<run>`` (null id: empty) the run lacks its code point number crc32 mod length.
    Counts are added up per task before the shuffle.
    """
    def to_counts(batches):
        held, size = [], 0

        def flush():
            got = pa.table({"word": pa.concat_arrays([w for w, _ in held]), "n": np.concatenate([n for _, n in held])})
            return got.group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"]).to_batches(max_chunksize=50_000)

        for b in batches:
            buf, off = utf8(b.column("text"))
            ids = b.column("id").to_pylist()
            for i, j in runs(off, RUN_BYTES):
                held.append(counted(buf[off[i]:off[j]], off[i:j + 1] - off[i], ids[i:j], every, least_length))
                size += int(off[j] - off[i])
                if size > FLUSH_BYTES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    src = docs.select(F.col(id_col).cast("long").cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (src.where("text IS NOT NULL").mapInArrow(to_counts, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _part(word: Column, start: Column, end: Column) -> Column:
    return F.substring(word, start + 1, end - start)


def _keys(word: Column, length: Column, shift: Column) -> list[Column]:
    """The four keys of a word for partners whose chunked side has ``length`` code points.

    ``shift`` is 0 on the chunked side and for partners of equal length, 1 on the side with
    the inserted code point.  Key: number, length, shift of the pair, chunk, half of the rest.
    """
    q, end = F.floor(length / 2).cast("int"), length + shift
    zero = F.lit(0)
    front = (q + length) / 2                                # middle of the rest behind the first chunk
    front, back = F.floor(front).cast("int"), F.floor(q / 2).cast("int")
    first, second = _part(word, zero, q), _part(word, q + shift, end)
    return [F.struct(first.alias("chunk"), _part(word, q, front).alias("half")),
            F.struct(first.alias("chunk"), _part(word, front + shift, end).alias("half")),
            F.struct(second.alias("chunk"), _part(word, zero, back).alias("half")),
            F.struct(second.alias("chunk"), _part(word, back + shift, q + shift).alias("half"))]


def _keyed(words: DataFrame, length: Column, shift: Column, side: str) -> DataFrame:
    numbered = F.array(*[F.struct(F.lit(i).alias("which"), k.alias("key")) for i, k in enumerate(_keys(F.col("word"), length, shift))])
    return words.withColumn("__k", F.explode(numbered)).select(
        F.xxhash64(F.col("__k.which"), length, F.col("__k.key.chunk"), F.col("__k.key.half")).alias("key"),
        F.col("word").alias(side), F.col("n").alias(f"{side}_n"),
        *([F.col("__k.which").alias("which")] if side == "x" else [shift.alias("shift")]))


def _one_edit(x: Column, y: Column, shift: Column) -> Column:
    """Whether one code point replaced (``shift`` 0) or inserted (1) makes ``y`` of ``x``; linear in long words."""
    a, b = F.split(x, ""), F.split(y, "")
    same = F.zip_with(a, F.slice(b, 1, F.size(a)), lambda u, v: u == v)
    front = F.array_position(same, F.lit(False)).cast("int")           # the first differing place, from 1; 0: none
    long = F.when((front == 0) & (shift == 1), F.lit(True)).when(front == 0, F.lit(False)).otherwise(
        F.substring(x, front + 1 - shift, F.length(x)) == F.substring(y, front + 1, F.length(y)))
    return F.when(F.length(x) <= LONG, F.levenshtein(x, y, 1) == 1).otherwise(long)


def near_pairs(words: DataFrame) -> DataFrame:
    """``(x, x_n, y, y_n)``: every pair of distinct words one inserted, deleted or replaced code point apart, once.

    ``words``: distinct ``(word, n)``, no nulls.  Of two words of one length ``x`` is the smaller.
    """
    length, zero, shift = F.length("word"), F.lit(0), F.col("shift")
    x = _keyed(words, length, zero, "x")
    y = _keyed(words.withColumn("__s", F.explode(F.array(F.lit(0), F.lit(1)))), length - F.col("__s"), F.col("__s"), "y")
    met = x.join(y, "key").where((F.length("x") + shift == F.length("y")) & ((shift == 1) | (F.col("x") < F.col("y"))))
    # the keys that the two words really share, in order; the pair counts under the first of them only
    same = [a == b for a, b in zip(_keys(F.col("x"), F.length("x"), zero), _keys(F.col("y"), F.length("x"), shift))]
    first = F.lit(None).cast("int")
    for i, s in reversed(list(enumerate(same))):
        first = F.when(s, i).otherwise(first)
    return met.where(_one_edit(F.col("x"), F.col("y"), shift)).where(F.col("which") == first).select("x", "x_n", "y", "y_n")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)`` rows without nulls: forms followed to the last by pointer doubling.

    Forms never lead in a circle (their counts grow).  Every round is written to the shared folder.
    """
    now = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while now.where("moved").limit(1).count():
        step = now.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        now = stored(now.join(step, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "spelling-roots")
    return now.select("word", "root")


def group_variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for distinct ``(word, n)`` rows.

    ``form``: the near word of largest ``n`` (ties: smallest in code-point order) if that is at least
    ``factor`` (at least 2) times the word's; ``root``: forms followed to the last, the word itself without one.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2, or forms could lead in a circle")
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    pairs = near_pairs(words)
    one = F.explode(F.array(F.struct(F.col("x").alias("word"), F.col("x_n").alias("n"), F.col("y").alias("near"), F.col("y_n").alias("near_n")),
                            F.struct(F.col("y").alias("word"), F.col("y_n").alias("n"), F.col("x").alias("near"), F.col("x_n").alias("near_n"))))
    links = pairs.select(one.alias("p")).select("p.*").unionByName(
        words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))))
    told = links.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    has = -F.col("best.minus") >= F.lit(factor) * F.col("n")
    told = stored(told.select("word", "n", "n_near", F.when(has, F.col("best.near")).alias("form"),
                              F.when(has, -F.col("best.minus")).alias("form_n")), "spelling-near")
    varied = told.where("form IS NOT NULL")
    order = ["word", "form", "root", "n", "n_near", "form_n"]
    return (told.where("form IS NULL").withColumn("root", F.col("word")).select(*order)
            .unionByName(varied.join(roots(varied), "word").select(*order)))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199, least_length: int = 6,
                      least_count: int = 5, factor: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per word of ``docs`` (see ``word_counts``, ``group_variants``).

    Null texts and texts without letters give no words; a null id reads as empty; repeated rows count each;
    words of any length take part.  An empty table gives no rows; other columns are ignored.
    """
    return group_variants(word_counts(docs, id_col, text_col, every, least_length, least_count), factor)
