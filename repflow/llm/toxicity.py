"""Toxicity by maximum-scoring segments.

1. Token log-odds (by texts that hold the token) of toxic against clean text with an informative Dirichlet
   prior (the pooled token distribution), learnt from a bounded sample of
   labelled rows; a token counts when its likelihood ratio against equal shares
   reaches ``min_g2``.  Every token also costs ``drift``, so clean text has a negative mean.
2. One linear scan per text finds all maximal scoring segments (each is the
   best of any stretch that holds it); only tokens with a positive score are
   visited one by one.
3. A segment of score ``s`` in ``n`` tokens has ``E = K n exp(-lambda s)`` expected equals
   in clean text; ``lambda`` solves the clean score distribution, ``K`` is fitted to
   the best segments of clean texts (extreme-value law).  Passages with
   ``E <= max_e`` are significant; a text's evidence is the log of the sum of theirs.
4. A one-variable logistic fit on the sample turns evidence into a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repflow.llm.textkernel import LOWER, runs, segment_hash, utf8, words

ALNUM = np.ones(256, dtype=bool)
ALNUM[:128] = [chr(c).isalnum() for c in range(128)]
PASSAGES = "array<struct<start:int,end:int,score:double,e_value:double>>"
HASH_RANGE = 1 << 30


def tokens(buf: np.ndarray, offsets: np.ndarray):
    """``(hashes, starts, ends, first)`` of the lower-cased letter and digit runs."""
    starts, ends, first = words(buf, offsets, ALNUM)
    return segment_hash(LOWER[buf], starts, ends), starts, ends, first


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` of a score sequence, in order.

    Every open segment knows the nearest earlier one that starts at a lower sum, so the search for it
    skips all others, which no later search visits again: the scan is linear in the sequence.
    """
    total = np.cumsum(scores)
    places = np.flatnonzero(scores > 0)
    out: list[tuple[int, int, float, float, int]] = []       # start, end, sum before, sum after, nearest lower
    for p, after, gain in zip(places.tolist(), total[places].tolist(), scores[places].tolist()):
        start, before, j = p, after - gain, len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= before:
                j = out[j][4]
            if j < 0 or out[j][3] >= after:
                out.append((start, p + 1, before, after, j))
                break
            start, _, before, _, lower = out[j]
            del out[j:]
            j = lower
    return [(s, e, r - l) for s, e, l, r, _ in out]


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "toxic", max_rows: int = 20_000, drift: float = 0.25,
        min_g2: float = 25.0, max_e: float = 0.05, seed: int = 5) -> dict:
    """Model from at most about ``max_rows`` labelled rows (seeded sample by id; whole texts).

    ``learn`` is a condition on the label rows.  Several labels of one id: the largest counts.
    """
    spark = docs.sparkSession
    usable = labels.where(F.coalesce(learn, F.lit(False))).select(
        F.col(label_id).cast("long").alias("lid"), F.col(label_col).cast("int").alias("y")) \
        .where("lid IS NOT NULL AND y IS NOT NULL")
    n = usable.count()
    h = F.pmod(F.xxhash64(F.lit(seed), "lid"), F.lit(HASH_RANGE))
    sample = usable.where(h < F.lit(int(HASH_RANGE * min(1.0, max_rows / max(n, 1))))) \
        .groupBy("lid").agg(F.max("y").alias("y"))
    d = docs.select(F.col(id_col).cast("long").alias("lid"), F.col(text_col).cast("string").alias("text"))
    train = d.join(F.broadcast(sample), "lid").select("text", "y")       # the sample side is bounded by max_rows

    def count(batches):
        for b in batches:
            buf, off = utf8(b.column("text"))
            toxic = b.column("y").to_numpy() > 0
            for i, j in runs(off):
                th, _, _, first = tokens(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                once = [np.unique(th[f:t]) for f, t in zip(first[:-1], first[1:])]      # a text counts a token once
                y = np.repeat(toxic[i:j], [len(x) for x in once])
                u, inv = np.unique(np.concatenate(once), return_inverse=True)
                n1 = np.bincount(inv, weights=y, minlength=len(u)).astype(np.int64)
                yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(n1), pa.array(
                    np.bincount(inv, minlength=len(u)) - n1)], names=["token", "n1", "n0"])

    counts = train.mapInArrow(count, "token long, n1 long, n0 long").groupBy("token").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    sums = counts.agg(F.sum("n1"), F.sum("n0")).first()
    n1, n0 = float(sums[0] or 0), float(sums[1] or 0)
    model = {"token": np.zeros(0, np.uint64), "score": np.zeros(0), "drift": drift, "max_e": max_e,
             "lam": 1.0, "k": 1.0, "a": 0.0, "b": -3.0}
    if not n1 or not n0:                   # one class only: nothing to tell apart
        model["b"] = 3.0 if n1 else -3.0
        return model
    q = (F.col("n1") + F.col("n0")) / F.lit(n1 + n0) * F.lit(n1)          # prior counts: as many as toxic tokens
    odds = F.log((F.col("n1") + q) / F.lit(2 * n1)) - F.log((F.col("n0") + q) / F.lit(n0 + n1))
    half = lambda n, e: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / e)).otherwise(F.lit(0.0))
    g2 = 2 * (half("n1", q) + half("n0", F.col("n1") + F.col("n0") - q))     # likelihood ratio against equal shares
    rows = counts.select("token", odds.alias("odds"), g2.alias("g2"), ((F.col("n0") + q) / F.lit(n0 + n1)).alias("p0")) \
        .where(F.col("g2") >= min_g2).orderBy("token").collect()         # bounded by the sample's vocabulary
    token = np.array([r["token"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(token)
    model["token"] = token[order]
    model["score"] = np.array([r["odds"] - drift for r in rows], float)[order]
    # lambda: sum p(s) exp(lambda s) = 1 over clean tokens
    p = np.array([r["p0"] for r in rows], float)[order]        # clean frequency, under the same prior
    rest = 1 - p.sum()
    lo, hi = 0.0, 1.0
    mean = lambda x: float((p * np.exp(np.minimum(x * model["score"], 500))).sum() + rest * np.exp(-x * drift))
    while mean(hi) < 1 and hi < 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    model["lam"] = max(hi, 1e-3)
    seen = _scan(train, {"y": F.col("y")}, model, spark, "text").select(
        "y", "n_tokens", "evidence", F.coalesce(F.array_max(F.transform("passages", lambda s: s["score"])), F.lit(0.0)).alias("m"))
    clean = seen.where("y <= 0 AND n_tokens > 0").agg(F.avg(F.col("n_tokens") * F.exp(-F.lit(model["lam"]) * F.col("m")))).first()[0]
    model["k"] = 1 / clean if clean else 1.0
    xy = _scan(train, {"y": F.col("y")}, model, spark, "text").groupBy(F.round("evidence", 2).alias("x")).agg(
        F.sum((F.col("y") > 0).cast("long")).alias("n1"), F.count(F.lit(1)).alias("n")).collect()   # bounded by max_rows
    x, k1, m = (np.array([float(r[c]) for r in xy]) for c in ("x", "n1", "n"))
    a, b = 0.0, 0.0
    for _ in range(50):                                # penalised Newton steps
        z = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = m * z * (1 - z)
        g = np.array([(x * (k1 - m * z)).sum() - 1e-3 * a, (k1 - m * z).sum()])
        hess = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(hess, g)
        a, b = a + float(np.clip(step[0], -2, 2)), b + float(np.clip(step[1], -2, 2))
    model["a"], model["b"] = max(a, 0.0), b
    return model


def _scan(docs: DataFrame, carry: dict[str, Column], model: dict, spark, text_col: str) -> DataFrame:
    """``carry`` plus ``n_tokens, passages, evidence, score`` per row: the one scan used to fit and to score."""
    shared, names = spark.sparkContext.broadcast(model), list(carry)
    src = docs.select(*[c.alias(n) for n, c in carry.items()], F.col(text_col).cast("string").alias("__text"))

    def scan(batches):
        m = shared.value
        table, value, drift, lam, k, log_max = m["token"], m["score"], m["drift"], m["lam"], m["k"], np.log(m["max_e"])
        for b in batches:
            buf, off = utf8(b.column("__text"))
            n_tokens, found, evidence = np.zeros(b.num_rows, np.int64), [[] for _ in range(b.num_rows)], np.zeros(b.num_rows)
            for i, j in runs(off):
                th, starts, ends, first = tokens(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                s = np.full(len(th), -drift)
                if len(table) and len(th):
                    at = np.minimum(np.searchsorted(table, th), len(table) - 1)
                    hit = table[at] == th
                    s[hit] = value[at[hit]]
                n_tokens[i:j] = np.diff(first)
                ups = np.concatenate([[0], np.cumsum(s > 0)])
                for r in np.flatnonzero(ups[first[1:]] > ups[first[:-1]]):
                    f, t = int(first[r]), int(first[r + 1])
                    base = int(off[i + r] - off[i])
                    for x, y, v in segments(s[f:t]):
                        log_e = np.log(k * (t - f)) - lam * v
                        if log_e <= log_max:
                            found[i + r].append({"start": int(starts[f + x]) - base, "end": int(ends[f + y - 1]) - base,
                                                 "score": v, "e_value": float(np.exp(log_e))})
                            evidence[i + r] += log_max - log_e + 1
            evidence = np.log1p(evidence)
            score = 1 / (1 + np.exp(-np.clip(m["a"] * evidence + m["b"], -30, 30)))
            yield pa.record_batch([b.column(n) for n in names] + [
                pa.array(n_tokens), pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), (
                    "score", pa.float64()), ("e_value", pa.float64())]))), pa.array(evidence), pa.array(score)],
                names=[*names, "n_tokens", "passages", "evidence", "score"])

    from pyspark.sql.types import _parse_datatype_string

    schema = src.select(*names).schema
    for f in _parse_datatype_string(f"n_tokens long, passages {PASSAGES}, evidence double, score double").fields:
        schema = schema.add(f)
    return src.mapInArrow(scan, schema)


def score_documents(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                    **kw) -> DataFrame:
    """``(doc_id, held_out, score, predicted, n_tokens, passages)``, one row per input row.

    ``held_out`` is a condition on ``doc_id`` that holds for label rows too; such
    labels are never learnt.  ``passages`` are the significant toxic stretches as
    byte ranges of the UTF-8 text.  Null and empty texts have no passage and get the score
    of no evidence; null ids count as held out; without labels of both classes
    every text gets one constant score.  An empty table gives no rows.
    """
    out = F.coalesce(held_out, F.lit(True))
    model = fit(docs, labels, ~out, id_col, text_col, **kw)
    r = _scan(docs, {"doc_id": F.col(id_col).cast("long"), "held_out": out}, model, docs.sparkSession, text_col)
    return r.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_tokens", "passages")
