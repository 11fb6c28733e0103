"""LM scoring by context-tree weighting over bytes.

A text is its words (A-Z lower-cased), each spelled as its bytes and a space, and
one end symbol.  The context of a byte is the up to ``depth`` bytes before it, across
words.  A byte is eight binary decisions; each
decision has its own context tree whose nodes hold counts of zeros and ones and
the Krichevsky-Trofimov estimate ``P_e``.  Weighting runs from the deepest contexts up:

    P_w(s) = (P_e(s) + prod over longer contexts of P_w) / 2

so a node's share ``P_e / (2 P_w)`` is the weight of stopping there.  With the counts
of the training texts fixed, a decision's probability mixes the estimates of all depths
along its context by these shares (a context never seen adds nothing).

Counts, model and look-ups are tables spread by key; none is collected or sent to
every task.  Texts are cut into chunks of bounded size; a chunk asks for the
distinct words and byte grams it holds and meets exactly those answers again; a gram
table of at most ``max_shared`` rows (counted first) goes to all tasks instead.  The
trees' top (at most 256 x 256 nodes) is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repflow.llm.tables import stored
from repflow.llm.textkernel import LOWER, runs, segment_hash, utf8, words

SPACE, END = 0x20, 0x0A
MAX_RANGES = 256
FLUSH = 1_200_000
RUN_BYTES = 1 << 18                      # text priced at a time; its sorts and look-ups stay in cache
LN2 = float(np.log(2))


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0 (shifted Stirling series)."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7) - shift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov block probability of ``n0`` zeros and ``n1`` ones."""
    return lgamma(n0 + 0.5) + lgamma(n1 + 0.5) - lgamma(n0 + n1 + 1) - np.log(np.pi)


def stream(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(symbols, begin)``: per document its words, each with a space behind it, and the end symbol."""
    n = ends - starts + 1
    docs = len(first) - 1
    doc = np.repeat(np.arange(docs), np.diff(first))
    size = np.bincount(doc, n, docs).astype(np.int64) + 1
    begin = np.cumsum(size) - size
    out = np.empty(int(n.sum()) + docs, np.uint8)
    solid = np.ones(len(out), bool)
    behind = np.cumsum(n) - 1 + doc                          # one end symbol per document before
    out[behind], solid[behind] = SPACE, False
    out[begin + size - 1], solid[begin + size - 1] = END, False
    edge = np.zeros(len(buf) + 1, np.int8)                   # 1 where a word starts, -1 where one ends and none starts
    edge[starts] = 1
    edge[ends] -= 1
    out[solid] = LOWER[buf[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]]
    return out, begin


def grams_of(symbols: np.ndarray, begin: np.ndarray, depth: int) -> np.ndarray:
    """Per symbol its gram: the symbol in the lowest byte, the context bytes, nearest first, above it (0 before the text)."""
    gram, have = symbols.astype(np.uint64), 1
    while have <= depth:                                     # bytes so far, and as many more from the gram that lies that far back
        more = min(have, depth + 1 - have)
        back = gram[:-have] & np.uint64((1 << (8 * more)) - 1)
        gram[have:] |= back << np.uint64(8 * have)
        have += more
    size = np.diff(np.append(begin, len(symbols)))
    for p in range(depth):                                   # nothing lies before a text
        gram[begin[size > p] + p] &= np.uint64((1 << (8 * (p + 1))) - 1)
    return gram


def node_sums(keys: np.ndarray, n: np.ndarray):
    """Binary nodes of distinct ``(context, symbol)`` keys.

    ``(at, zeros, ones, contexts, node)``: per key and bit the index of its node; per node
    its counts, context and position in the byte's decision tree.
    """
    symbol = (keys & np.uint64(255)).astype(np.int64)
    _, ctx = np.unique(keys >> np.uint64(8), return_inverse=True)
    k = np.arange(8)
    v = (1 << k) | (symbol[:, None] >> (8 - k))
    bit = (symbol[:, None] >> (7 - k)) & 1
    u, one, at = np.unique(ctx[:, None] * 256 + v, return_index=True, return_inverse=True)
    at = at.reshape(v.shape)
    w = np.repeat(n[:, None], 8, 1)
    zeros = np.bincount(at.ravel(), (w * (1 - bit)).ravel(), len(u))
    ones = np.bincount(at.ravel(), (w * bit).ravel(), len(u))
    return at, bit, zeros, ones, (keys >> np.uint64(8))[one // 8], u % 256


def subtree(grams: np.ndarray, n: np.ndarray, depth: int, top: int):
    """Weight the trees below contexts of ``top`` bytes.

    ``(mixed, nodes)``: per gram and bit the mixed probability of its bit at depth ``top``
    (NaN where no context that long was seen); and the depth's nodes
    ``(context, node, zeros, ones, log P_w)``.
    """
    levels, keys, owner = [], grams, np.arange(len(grams))
    counts = n.astype(float)
    for d in range(depth, top - 1, -1):
        mask = np.uint64((1 << (8 * (d + 1))) - 1) if d < 7 else np.uint64(0xFFFFFFFFFFFFFFFF)
        keys, inv = np.unique(keys & mask, return_inverse=True)
        counts = np.bincount(inv, counts, len(keys))
        owner = inv[owner]
        levels.append((owner, *node_sums(keys, counts)))
    mixed, log_w, below = None, None, None
    for owner, at, bit, zeros, ones, ctx, v in levels:       # deepest first
        log_e = log_kt(zeros, ones)
        a, b = at[owner], bit[owner]
        total = zeros + ones
        p = (np.where(b == 1, ones[a], zeros[a]) + 0.5) / (total[a] + 1)
        if mixed is None:
            log_w, q = log_e, p
        else:
            parent = np.zeros(len(log_w), np.int64)
            parent[below.ravel()] = a.ravel()
            kids = np.bincount(parent, log_w, len(zeros))
            log_w = np.logaddexp(log_e, kids) - LN2
            stop = np.exp(log_e - LN2 - log_w)[a]
            q = np.where(np.isnan(mixed), p, stop * p + (1 - stop) * mixed)
        mixed = np.where(total[a] > 0, q, np.nan)
        below = a
    return mixed, (ctx, v, zeros, ones, log_w)


def _sorted(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned keys in order, with their values (those of equal keys are the same)."""
    key = key.view(np.uint64)
    order = np.argsort(key)
    return key[order], value[order]


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their ``n``; sorted runs are merged."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[at], np.add.reduceat(n[order], at) if len(at) else n[:0]


def _chunk(df: DataFrame, id_col: str, n_chunks: int) -> Column:
    """Chunk number of a row: ranges of the id (so stored neighbours meet), split further by hash; rows without an id go to all chunks."""
    ranges = min(n_chunks, MAX_RANGES)
    at = df.where(F.col(id_col).isNotNull()).approxQuantile(id_col, [i / ranges for i in range(1, ranges)], 0.002) if ranges > 1 else []
    below = F.size(F.filter(F.array(*[F.lit(float(x)) for x in at]), lambda x: x < F.col(id_col))) if at else F.lit(0)
    splits = -(-n_chunks // ranges)
    spread = F.xxhash64(id_col, "text")
    return F.when(F.col(id_col).isNull(), F.pmod(spread, F.lit(ranges * splits)).cast("int")).otherwise(
        F.coalesce(below, F.lit(0)) * splits + F.pmod(spread, F.lit(splits)).cast("int"))


def score_texts(docs: DataFrame, held_out: Column, depth: int = 5, chunk_bytes: int = 24 << 20, max_shared: int = 2_000_000, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)``, one row per input row.

    Learns from the rows that are not held out.  ``score`` is the model's log10
    probability of the text, ``base_score`` that of add-one word counts; tokens are the words
    and one end.  Null and empty texts are the end alone; a null id counts as
    held out; with nothing to learn from all counts are 0 and every decision
    has probability 1/2.  An empty table gives no rows; other columns are ignored.
    """
    if not 2 <= depth <= 7:
        raise ValueError("depth is 2 to 7 bytes")
    out = F.coalesce(held_out, F.lit(True))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), out.alias("held_out"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = src.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held_out"))).first()
    n_chunks, train_docs = max(1, -(-int(size[0] or 0) // chunk_bytes)), int(size[1] or 0)
    src = src.withColumn("chunk", _chunk(src, "doc_id", n_chunks).cast("int"))

    def ask(batches):
        held: dict[int, list] = {}
        names = ["chunk", "kind", "key", "n"]

        def merged(parts, kind):
            parts = [x for x in parts if x[0] == kind]
            if len(parts) == 1:
                return parts[0]
            return kind, *_summed(np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts]))

        def emit(chunk):
            for kind in (0, 1):
                _, u, n = merged(held[chunk], kind)
                yield pa.record_batch([pa.array(np.full(len(u), chunk, np.int32)), pa.array(np.full(len(u), kind, np.int8)),
                                       pa.array(u.view(np.int64)), pa.array(n)], names=names)
            del held[chunk]

        for b in batches:
            buf, off = utf8(b.column("text"))
            chunk = b.column("chunk").to_numpy()
            train = ~b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for i, j in runs(off, 1 << 19):
                part, at = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                starts, ends, first = words(part, at)
                h = segment_hash(LOWER[part], starts, ends)
                doc = np.repeat(np.arange(i, j), np.diff(first))
                symbols, begin = stream(part, starts, ends, first)
                g = grams_of(symbols, begin, depth)
                of = np.repeat(np.arange(i, j), np.diff(np.append(begin, len(g))))
                for c in np.unique(chunk[i:j]).tolist():
                    for kind, keys, row in ((0, h, doc), (1, g, of)):
                        own = chunk[row] == c
                        learn = own & train[row]
                        u, n = np.unique(keys[learn], return_counts=True)
                        rest = np.unique(keys[own & ~learn], return_counts=True)[0]      # the way that sorts
                        held.setdefault(c, []).append((kind, *_summed(np.concatenate([u, rest]), np.append(n, np.zeros(len(rest), np.int64)))))
                    if sum(len(x[1]) for x in held[c]) > FLUSH:
                        held[c] = [merged(held[c], kind) for kind in (0, 1)]
                        if sum(len(x[1]) for x in held[c]) > FLUSH // 2:
                            yield from emit(c)
            for c in list(held):                  # chunks that lie behind
                if len(held) > 2 and c not in chunk:
                    yield from emit(c)
        for c in list(held):
            yield from emit(c)

    asked = stored(src.select("text", "chunk", "held_out").mapInArrow(ask, "chunk int, kind tinyint, key long, n long"), "asked")
    word_rows = asked.where("kind = 0").select("chunk", "key", F.sum("n").over(Window.partitionBy("key")).cast("double").alias("value"),
                                               (F.row_number().over(Window.partitionBy("key").orderBy("chunk")) == 1).alias("one"))
    word_rows = stored(word_rows, "wordcounts")
    sums = word_rows.where("one AND value > 0").agg(F.sum("value"), F.count(F.lit(1))).first()
    n_train = int(sums[0] or 0) + train_docs
    vocab = int(sums[1]) + (train_docs > 0)

    grams = asked.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n"))
    near = F.shiftrightunsigned(F.col("key"), 8).bitwiseAND(F.lit(0xFFFF))           # two nearest context bytes

    def weigh(t: pa.Table) -> pa.Table:
        mixed, (ctx, v, zeros, ones, log_w) = subtree(t["key"].to_numpy().view(np.uint64), t["n"].to_numpy(), depth, 2)
        none = [None] * len(mixed)
        empty = [None] * len(v)
        flat = pa.array(mixed.ravel(), pa.float64())
        q = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 8, dtype=np.int32)), flat)
        return pa.table({
            "key": pa.concat_arrays([t["key"].combine_chunks(), pa.array(empty, pa.int64())]),
            "q": pa.concat_arrays([q, pa.array(empty, q.type)]),
            "c1": pa.concat_arrays([pa.array(none, pa.int32()), pa.array((ctx & np.uint64(255)).astype(np.int32))]),
            "v": pa.concat_arrays([pa.array(none, pa.int32()), pa.array(v.astype(np.int32))]),
            "zeros": pa.concat_arrays([pa.array(none, pa.float64()), pa.array(zeros)]),
            "ones": pa.concat_arrays([pa.array(none, pa.float64()), pa.array(ones)]),
            "log_w": pa.concat_arrays([pa.array(none, pa.float64()), pa.array(log_w)])})

    weighed = stored(grams.withColumn("near", near).groupBy("near").applyInArrow(
        weigh, "key long, q array<double>, c1 int, v int, zeros double, ones double, log_w double"), "weighed")
    # the two top levels: at most 256 contexts x 255 decisions
    top = weighed.where("v IS NOT NULL").groupBy("c1", "v").agg(F.sum("zeros"), F.sum("ones"), F.sum("log_w")).collect()
    zeros, ones, kids = (np.zeros((256, 256)) for _ in range(3))
    for c1, v, *x in top:
        zeros[c1, v], ones[c1, v], kids[c1, v] = x
    tops = []
    for z, o, k in ((zeros, ones, kids), (zeros.sum(0), ones.sum(0), None)):
        log_e = log_kt(z, o)
        if k is None:
            k = log_w1.sum(0)
        log_w = np.logaddexp(log_e, k) - LN2
        log_w1 = log_w
        tops.append((np.exp(log_e - LN2 - log_w), z, o))
    shared = docs.sparkSession.sparkContext.broadcast(tops)

    def price(batches):
        (s1, z1, o1), (s0, z0, o0) = shared.value
        for b in batches:
            key = b.column("key").to_numpy().view(np.uint64)
            q = b.column("q").flatten().to_numpy(zero_copy_only=False).reshape(len(key), 8)
            symbol, c1 = (key & np.uint64(255)).astype(np.int64), ((key >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
            k = np.arange(8)
            v, bit = (1 << k) | (symbol[:, None] >> (8 - k)), (symbol[:, None] >> (7 - k)) & 1
            for s, z, o in ((s1[c1[:, None], v], z1[c1[:, None], v], o1[c1[:, None], v]), (s0[v], z0[v], o0[v])):
                p = (np.where(bit == 1, o, z) + 0.5) / (z + o + 1)
                q = np.where(z + o > 0, np.where(np.isnan(q), p, s * p + (1 - s) * q), np.nan)
            q = np.where(np.isnan(q), 0.5, q)
            yield pa.record_batch([b.column("key"), pa.array(np.log10(q).sum(1))], names=["key", "value"])

    price_list = weighed.where("key IS NOT NULL").select("key", "q").mapInArrow(price, "key long, value double")
    answers = word_rows.select(F.col("chunk").alias("c"), F.lit(0).cast("tinyint").alias("kind"), "key", "value")
    whole = None
    if weighed.where("key IS NOT NULL").count() <= max_shared:           # a table of that size goes to every task at once
        t = price_list.toArrow()
        whole = docs.sparkSession.sparkContext.broadcast(_sorted(t["key"].to_numpy(), t["value"].to_numpy()))
    else:                                                                # otherwise every chunk meets the grams it asked for
        gram_rows = asked.where("kind = 1").select("chunk", "key").join(price_list, "key")
        answers = answers.unionByName(gram_rows.select(F.col("chunk").alias("c"), F.lit(1).cast("tinyint").alias("kind"), "key", "value"))
    smooth = float(np.log10(n_train + vocab + 1))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]

    def answer(t: pa.Table, a: pa.Table) -> pa.Table:
        kind, key, value = a["kind"].to_numpy(), a["key"].to_numpy(), a["value"].to_numpy()
        wk, wc = _sorted(key[kind == 0], value[kind == 0])
        gk, gp = whole.value if whole is not None else _sorted(key[kind == 1], value[kind == 1])
        buf, off = utf8(t["text"])
        cols: list[list] = [[], [], [], [], []]
        for i, j in runs(off, RUN_BYTES):
            part, at = buf[off[i]:off[j]], off[i:j + 1] - off[i]
            starts, ends, first = words(part, at)
            u, inv = np.unique(segment_hash(LOWER[part], starts, ends), return_inverse=True)
            c = wc[np.searchsorted(wk, u)] if len(u) else np.zeros(0)
            symbols, begin = stream(part, starts, ends, first)
            grams_u, at_gram = np.unique(grams_of(symbols, begin, depth), return_inverse=True)       # sorted look-ups stay in cache
            price = gp[np.searchsorted(gk, grams_u)][at_gram]
            base, known = np.log10(c + 1), (c > 0).astype(np.int64)
            doc = np.repeat(np.arange(j - i), np.diff(first))
            m = j - i
            cols[0].append(np.diff(first) + 1)
            cols[1].append(np.bincount(doc, known[inv], m).astype(np.int64) + (train_docs > 0))
            cols[2].append(np.bincount(doc, base[inv], m) + np.log10(train_docs + 1) - smooth * (np.diff(first) + 1))
            cols[3].append(np.add.reduceat(price, begin))
            cols[4].append(np.diff(np.append(begin, len(symbols))))
        n, known, base, score, n_bytes = (np.concatenate(x) if x else np.zeros(0) for x in cols)
        return pa.table([t["doc_id"], t["held_out"], pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                         pa.array(np.full(len(n), n_train), pa.int64()), pa.array(base), pa.array(score),
                         pa.array(-score / np.log10(2) / n_bytes)], names=names)

    return src.groupBy("chunk").cogroup(answers.groupBy("c")).applyInArrow(
        answer, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double, bits_per_byte double")
