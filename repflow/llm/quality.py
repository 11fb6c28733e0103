"""Quality by an interpolated modified Kneser-Ney byte n-gram model of trusted text.

1. All trusted texts take part: three quarters (by a seeded hash of the id) train,
   the rest calibrate.
2. Counts, continuation counts and context totals are tables spread by n-gram.
   Order by order they are joined: discounted counts to the totals of their
   context, then to the probability of their shorter n-gram,

       p(w | c) = (n(cw) - D(n(cw))) / n(c) + gamma(c) p(w | c'),

   with three discounts per order from the counts of counts, raw counts at the top order and
   continuation counts below.
3. A model of at most ``max_shared`` rows (counted first) goes to the tasks that score whole texts,
   backing off where an n-gram is unknown.  A larger one stays in its tables: texts are cut into chunks of
   bounded size, the distinct n-grams of a chunk are priced by joins and meet the chunk again.
4. A text is kept while its perplexity does not pass that of the ``quantile`` of all
   calibration texts in its language (all languages together where fewer than
   ``min_texts`` are known), widened by ``margin``.  Short texts are drawn towards the
   calibration mean by ``prior_bytes`` pseudo-bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repflow.llm.ctw import grams_of
from repflow.llm.tables import stored
from repflow.llm.textkernel import SPACE, runs, utf8

MAX_RANGES = 256
FLUSH = 2_000_000


def _symbols(buf: np.ndarray) -> np.ndarray:
    """The bytes of a text, any white space as a space."""
    return np.where(SPACE[buf], np.uint8(32), buf)


def _grams(buf: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    begin = offsets[:-1][np.diff(offsets) > 0]
    return grams_of(_symbols(buf), begin, order - 1) if len(buf) else np.zeros(0, np.uint64)


def _mask(m: int) -> int:
    return (1 << (8 * m)) - 1


def _merged(parts: list) -> list:
    """One ``(distinct n-grams, counts)`` of several."""
    u, inv = np.unique(np.concatenate([u for u, _ in parts]), return_inverse=True)
    return [(u, np.bincount(inv, np.concatenate([n for _, n in parts]), len(u)).astype(np.int64))]


def model_frames(train: DataFrame, order: int) -> list[tuple[DataFrame, DataFrame]]:
    """Per order, from 1: the tables ``(g, p)`` and ``(c, gamma)`` of the training texts ``(text)``."""
    def count(batches):
        held: list = []
        for b in batches:
            buf, off = utf8(b.column("text"))
            for i, j in runs(off):
                held.append(np.unique(_grams(buf[off[i]:off[j]], off[i:j + 1] - off[i], order), return_counts=True))
                if sum(len(u) for u, _ in held) > FLUSH:
                    held = _merged(held)
                    if len(held[0][0]) > FLUSH // 2:
                        yield _batch(g=held[0][0].view(np.int64), n=held[0][1])
                        held = []
        if held:
            (u, n), = _merged(held)
            yield _batch(g=u.view(np.int64), n=n)

    counts = {order: stored(train.mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")), "ngrams")}
    for m in range(order - 1, 0, -1):           # continuation counts: distinct bytes in front
        counts[m] = stored(counts[m + 1].groupBy(F.col("g").bitwiseAND(F.lit(_mask(m))).alias("g")).agg(
            F.count(F.lit(1)).alias("n")), "ngrams")
    out, lower = [], None
    for m in range(1, order + 1):
        c = counts[m]
        n1, n2, n3, n4 = (float(x) for x in c.agg(*[F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]).first())
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        d = [max(0.0, i - (i + 1) * y * b / a) if a else 0.0 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        ctx = c.groupBy(F.shiftright("g", 8).alias("c")).agg(F.sum("n").alias("total"), (F.sum(cut) / F.sum("n")).alias("gamma"))
        p = c.withColumn("c", F.shiftright("g", 8)).join(ctx, "c")
        alpha = (F.col("n") - cut) / F.col("total")
        if lower is None:
            p = p.select("g", (alpha + F.col("gamma") / 256).alias("p"))
        else:
            low = lower.select(F.col("g").alias("short"), F.col("p").alias("q"))
            p = p.withColumn("short", F.col("g").bitwiseAND(F.lit(_mask(m - 1)))).join(low, "short") \
                .select("g", (alpha + F.col("gamma") * F.col("q")).alias("p"))
        lower = stored(p, "kn")
        out.append((lower, stored(ctx.select("c", "gamma"), "gamma")))
    return out


def collected(frames: list[tuple[DataFrame, DataFrame]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The tables as ``(n-grams, log p, contexts, log gamma)``, sorted (the caller has counted the rows)."""
    out = []
    for frame in frames:
        arrays = []
        for t, key, value in zip(frame, ("g", "c"), ("p", "gamma")):
            t = t.toArrow()
            k, v = t[key].to_numpy(), t[value].to_numpy()
            o = np.argsort(k)
            arrays += [k[o].astype(np.uint64), np.log(np.maximum(v[o], 1e-300))]
        out.append(tuple(arrays))
    return out


def model_tables(train: DataFrame, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    return collected(model_frames(train, order))


def _batch(**columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c) for c in columns.values()], names=list(columns))


def _log_p(g: np.ndarray, tables) -> np.ndarray:
    """Natural log probability of each n-gram's last byte."""
    lp, left = np.zeros(len(g)), np.arange(len(g))
    for m in range(len(tables), 0, -1):
        keys, logs, ctx, gamma = tables[m - 1]
        if not len(left) or not len(keys):
            continue
        x = g[left] & np.uint64(_mask(m))
        at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
        hit = keys[at] == x
        lp[left[hit]] += logs[at[hit]]
        left, x = left[~hit], x[~hit]
        at = np.minimum(np.searchsorted(ctx, x >> np.uint64(8)), len(ctx) - 1)
        lp[left] += np.where(ctx[at] == x >> np.uint64(8), gamma[at], 0.0)
    lp[left] -= np.log(256)
    return lp


def price_list(asked: DataFrame, frames: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``(g, lp)``: natural log probability of the last byte of each distinct n-gram ``(g)``, by joins from the shortest order up."""
    need, out = [stored(asked, "need")], None
    for m in range(len(frames) - 1, 0, -1):
        need.append(stored(need[-1].select(F.col("g").bitwiseAND(F.lit(_mask(m))).alias("g")).distinct(), "need"))
    log = lambda c: F.log(F.when(F.col(c) > 1e-300, F.col(c)).when(F.col(c).isNotNull(), F.lit(1e-300)))
    for m, (g, (p, ctx)) in enumerate(zip(reversed(need), frames), 1):
        t = g.join(p, "g", "left").withColumn("c", F.shiftright("g", 8)).join(ctx, "c", "left")
        if out is None:
            t = t.withColumn("low", F.lit(-float(np.log(256))))
        else:                                   # at most 256 n-grams share a shorter one
            t = t.withColumn("short", F.col("g").bitwiseAND(F.lit(_mask(m - 1)))).join(
                out.select(F.col("g").alias("short"), F.col("lp").alias("low")), "short")
        out = t.select("g", F.coalesce(log("p"), F.coalesce(log("gamma"), F.lit(0.0)) + F.col("low")).alias("lp"))
    return out


def _chunk(src: DataFrame, n_chunks: int) -> Column:
    """Chunk number of a row: ranges of the id; rows without id, and an id that fills whole ranges, are spread by text."""
    ranges = min(n_chunks, MAX_RANGES)
    if ranges == 1:
        return F.lit(0)
    at = F.array(*[F.lit(float(x)) for x in src.where("id IS NOT NULL").approxQuantile("id", [i / ranges for i in range(1, ranges)], 0.002)])
    h = F.xxhash64("text")
    below = F.size(F.filter(at, lambda x: x < F.col("id"))) + F.pmod(h, F.size(F.filter(at, lambda x: x == F.col("id"))) + 1)
    splits = -(-n_chunks // ranges)
    return F.coalesce(F.when(F.col("id").isNull(), F.pmod(h, F.lit(ranges))).otherwise(below), F.lit(0)) * splits + F.pmod(F.xxhash64("id", "text"), F.lit(splits))


def _run_costs(text: pa.Array, order: int, log_p) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, cost)`` of each whole text; ``log_p`` gives the log probabilities of n-grams."""
    buf, off = utf8(text)
    total = np.zeros(len(off) - 1)
    for i, j in runs(off):
        lp = log_p(_grams(buf[off[i]:off[j]], off[i:j + 1] - off[i], order))
        at, full = off[i:j] - off[i], np.diff(off[i:j + 1]) > 0
        if full.any():
            total[i:j][full] = -np.add.reduceat(lp, at[full])
    return np.diff(off), total


def costs(src: DataFrame, frames: list[tuple[DataFrame, DataFrame]], max_shared: int, chunk_bytes: int) -> DataFrame:
    """The columns of ``src (id, text, ...)`` but the text, plus ``n_bytes`` and ``cost`` (natural log units) of each whole text."""
    order, names = len(frames), [c for c in src.columns if c != "text"]
    schema = src.select(*names).schema.add("n_bytes", "long").add("cost", "double")
    if sum(t.count() for frame in frames for t in frame) <= max_shared:        # a model of that size goes to every task at once
        shared = src.sparkSession.sparkContext.broadcast(collected(frames))

        def cost(batches):
            t = shared.value
            for b in batches:
                n, total = _run_costs(b.column("text"), order, lambda g: _log_p(g, t))
                yield pa.record_batch([b.column(c) for c in names] + [pa.array(n), pa.array(total)], names=[*names, "n_bytes", "cost"])

        return src.mapInArrow(cost, schema)

    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0              # otherwise every chunk meets the n-grams it asked for
    src = src.withColumn("chunk", _chunk(src, max(1, -(-int(size) // chunk_bytes))).cast("int"))

    def ask(batches):
        held: dict[int, list] = {}

        def emit(c):
            u = np.unique(np.concatenate(held.pop(c)))
            return _batch(chunk=np.full(len(u), c, np.int32), g=u.view(np.int64))

        for b in batches:
            chunk = b.column("chunk").to_numpy()
            for c in np.unique(chunk).tolist():
                buf, off = utf8(b.column("text").filter(pa.array(chunk == c)))
                for i, j in runs(off):
                    held.setdefault(c, []).append(np.unique(_grams(buf[off[i]:off[j]], off[i:j + 1] - off[i], order)))
                    if sum(map(len, held[c])) > FLUSH:
                        held[c] = [np.unique(np.concatenate(held[c]))]
                        if len(held[c][0]) > FLUSH // 2:
                            yield emit(c)
            for c in list(held):                  # chunks that lie behind
                if len(held) > 2 and c not in chunk:
                    yield emit(c)
        for c in list(held):
            yield emit(c)

    asked = stored(src.select("text", "chunk").mapInArrow(ask, "chunk int, g long"), "asked").distinct()
    answers = asked.join(price_list(asked.select("g").distinct(), frames), "g").select(F.col("chunk").alias("at"), "g", "lp")

    def answer(t: pa.Table, a: pa.Table) -> pa.Table:
        keys, value = a["g"].to_numpy().view(np.uint64), a["lp"].to_numpy()
        o = np.argsort(keys)
        keys, value = keys[o], value[o]
        n, total = _run_costs(t["text"], order, lambda g: value[np.searchsorted(keys, g)])
        return pa.table([*[t[c] for c in names], pa.array(n, pa.int64()), pa.array(total, pa.float64())], names=[*names, "n_bytes", "cost"])

    return src.groupBy("chunk").cogroup(answers.groupBy("at")).applyInArrow(answer, schema)


def quantiles(rows: DataFrame, q: float) -> DataFrame:
    """``(key, n, limit)``: exact ``q`` quantile (interpolated) of ``rate`` per ``key``.

    Counts per thousandth find where the rank lies; only the distinct values there are ordered.
    """
    values = stored(rows.groupBy("key", "rate").agg(F.count(F.lit(1)).alias("n")).withColumn("bin", F.floor(F.col("rate") * 1000)), "rates")
    up, whole = Window.partitionBy("key").orderBy("bin"), Window.partitionBy("key")
    rank = (F.col("total") - 1) * F.lit(q)
    bins = values.groupBy("key", "bin").agg(F.sum("n").alias("held")).select(
        "key", "bin", (F.sum("held").over(up) - F.col("held")).alias("before"), F.sum("held").over(up).alias("upto"), F.sum("held").over(whole).alias("total"))
    bins = bins.where((F.col("before") <= F.ceil(rank)) & (F.col("upto") > F.floor(rank)))
    bins = bins.withColumn("before", F.min("before").over(whole)).select("key", "bin", "before", "total")
    near = values.join(F.broadcast(bins), ["key", "bin"]).withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy("key").orderBy("rate")))
    low, high = (F.min(F.when(F.col("upto") > r, F.col("rate"))) for r in (F.floor(rank), F.ceil(rank)))
    frac = F.first(rank - F.floor(rank))
    return near.groupBy("key").agg(F.first("total").alias("n"), (low + frac * (high - low)).alias("limit"))


def quality(docs: DataFrame, trusted: DataFrame, order: int = 5, quantile: float = 0.995, margin: float = 0.05, min_texts: int = 50,
            prior_bytes: int = 200, seed: int = 17, max_shared: int = 4_000_000, chunk_bytes: int = 24 << 20, id_col: str = "doc_id",
            text_col: str = "text", lang_col: str = "lang", trusted_id: str = "doc_id") -> DataFrame:
    """``(doc_id, lang, n_bytes, perplexity, threshold, kept)``, one row per input row.

    ``trusted`` lists the ids of trusted texts; all of them train or calibrate.
    Perplexity is per byte.  Null and
    empty texts have no perplexity and are not kept; rows without language are judged
    by the threshold of all languages; without trusted text everything but
    empty texts is kept.  An empty table gives no rows; other columns are ignored.
    """
    if not 1 <= order <= 7:
        raise ValueError("order is 1 to 7 bytes")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = stored(trusted.select(F.col(trusted_id).cast("long").alias("tid")).where("tid IS NOT NULL").distinct(), "trusted")
    ids = F.broadcast(ids) if ids.count() <= max_shared // 4 else ids
    test = F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(4)) == 0
    frames = model_frames(src.join(ids, F.col("id") == F.col("tid"), "left_semi").where(~test & (F.col("text") != "")).select("text"), order)
    marked = src.join(ids, F.col("id") == F.col("tid"), "left").select("id", "lang", (F.col("tid").isNotNull() & test & (F.col("text") != "")).alias("told"), "text")
    out = stored(costs(marked, frames, max_shared, chunk_bytes), "costs")
    told = out.where("told")
    mean = told.agg(F.sum("cost") / F.nullif(F.sum("n_bytes"), F.lit(0))).first()[0]
    rate = (F.col("cost") + F.lit(prior_bytes * (mean or 0.0))) / (F.col("n_bytes") + F.lit(prior_bytes))
    key = F.concat(F.lit("="), "lang")                                          # "*": all languages
    limits = stored(quantiles(told.select(F.explode(F.array(F.lit("*"), key)).alias("key"), rate.alias("rate")).where("key IS NOT NULL"), quantile), "limits")
    every = limits.where("key = '*'").first()
    every = every["limit"] if every else float("inf")
    limits = limits.where((F.col("key") != "*") & (F.col("n") >= min_texts)).select("key", "limit")     # one row per language
    out = out.join(F.broadcast(limits), key == F.col("key"), "left")
    limit = F.exp(F.coalesce(F.col("limit"), F.lit(every)) * (1 + margin))
    perplexity = F.when(F.col("n_bytes") > 0, F.exp(rate))
    return out.select(F.col("id").alias("doc_id"), "lang", "n_bytes", perplexity.alias("perplexity"), limit.alias("threshold"),
                      F.coalesce(perplexity <= limit, F.lit(False)).alias("kept"))
