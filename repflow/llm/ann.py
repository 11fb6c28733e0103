"""Approximate nearest neighbours: stable projections in kd-trees with a chi-square stopping test.

Vectors are projected to ``m`` dimensions with a seeded Gaussian (2-stable) matrix,
so for a pair at distance ``d`` the squared projected distance over ``d^2`` follows a
chi-square law with ``m`` degrees of freedom.  Every block of rows holds a kd-tree over its
projections.  A query walks a tree best-first: projected neighbours come in
growing distance ``r`` and are verified on the original vectors in double
precision, until ``r^2 >= q d_k^2`` with ``d_k`` the k-th verified distance and ``q`` the
chi-square quantile of ``confidence``: a missed neighbour then has a projected distance that
happens with probability ``1 - confidence`` at most.

All distinct rows are indexed (repeated ones once).  Equal vectors share one tree point that keeps their ``k + 1``
smallest ids (no others can be among the ``k`` nearest), so a vector that fills a
third of the table costs one point per block.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repflow.llm.tables import stored

LEAF = 64


def chi2_quantile(p: float, m: int) -> float:
    """Quantile of the chi-square law, ``m`` even (closed-form distribution, bisected)."""
    if m % 2:
        raise ValueError("the number of projections is even")
    cdf = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
    lo, hi = 0.0, 10.0 * m + 100
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def projection(dim: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, m]).standard_normal((dim, m))


class Tree:
    """kd-tree over projections: points in leaf order, a bounding box per node (heap numbering)."""

    def __init__(self, low: np.ndarray):
        n = len(low)
        self.depth = max(0, math.ceil(math.log2(max(1, n / LEAF))))
        order = np.arange(n)
        cuts = np.array([0, n])
        self.boxes = []
        for d in range(self.depth + 1):
            lo = np.array([low[order[a:b]].min(0) for a, b in zip(cuts[:-1], cuts[1:])])
            hi = np.array([low[order[a:b]].max(0) for a, b in zip(cuts[:-1], cuts[1:])])
            self.boxes.append((lo, hi))
            if d == self.depth:
                break
            new = [0]
            for a, b, w in zip(cuts[:-1], cuts[1:], (hi - lo).argmax(1)):
                mid = (a + b) // 2
                part = order[a:b]
                order[a:b] = part[np.argpartition(low[part, w], mid - a)] if mid > a else part
                new += [mid, b]
            cuts = np.array(new)
        self.order, self.cuts = order, cuts

    def nearest_first(self, q: np.ndarray):
        """``(squared projected distance bound, point range)`` of the leaves, nearest first."""
        bounds = []
        for lo, hi in self.boxes:
            gap = np.maximum(np.maximum(lo - q, q - hi), 0)
            bounds.append((gap * gap).sum(1).tolist())
        heap = [(bounds[0][0], 0, 0)]
        while heap:
            r2, d, i = heapq.heappop(heap)
            if d == self.depth:
                yield r2, int(self.cuts[i]), int(self.cuts[i + 1])
            else:
                for c in (2 * i, 2 * i + 1):
                    heapq.heappush(heap, (bounds[d + 1][c], d + 1, c))


def search_block(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, qx: np.ndarray, k: int, m: int, quantile: float,
                 seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query ids, row ids, distances)``: each query's ``k`` nearest found in one block of distinct rows."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    _, first, group = np.unique(np.ascontiguousarray(x + 0.0).view(f"V{8 * x.shape[1]}").ravel(), return_index=True, return_inverse=True)
    members: list[list[int]] = [[] for _ in first]
    for i, g in zip(ids.tolist(), group.tolist()):
        if len(members[g]) <= k:
            members[g].append(i)
    points = x[first]
    p = projection(x.shape[1], m, seed)
    tree = Tree(points @ p)
    points, members = points[tree.order], [members[i] for i in tree.order]
    out: tuple[list, list, list] = ([], [], [])
    for qid, v, low in zip(qids.tolist(), qx, qx @ p):
        best: list[tuple[float, int]] = []
        for r2, a, b in tree.nearest_first(low):
            if len(best) >= k and r2 > 0 and r2 >= quantile * best[-1][0] ** 2:
                break
            diff = points[a:b] - v
            dist = np.sqrt((diff * diff).sum(1))
            near = np.flatnonzero(dist <= best[-1][0]) if len(best) >= k else range(b - a)
            found = {(float(dist[i]), j) for i in near for j in members[a + i] if j != qid}
            best = sorted(found.union(best))[:k]
        out[0].extend([qid] * len(best))
        out[1].extend(j for _, j in best)
        out[2].extend(d for d, _ in best)
    return tuple(np.array(c, t) for c, t in zip(out, (np.int64, np.int64, np.float64)))


def nearest(vectors: DataFrame, every: int, k: int = 10, m: int = 8, confidence: float = 0.9, block_rows: int = 16_384,
            query_rows: int = 8_192, seed: int = 3, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every row whose id divides by ``every``.

    Distance: Euclidean, in double precision on the original vectors; ties go
    to the smaller id.  Candidates are all rows but those with the query's own id; fewer
    than ``k`` are all returned.  Vectors that are null, zero or hold null or
    non-finite components take no part, nor do rows without id; vectors of
    different lengths are never compared.  A repeated row counts once; an id with
    several vectors is a candidate once per distinct distance.  An empty table gives
    no rows; other columns are ignored.
    """
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists(v, lambda e: e != 0))
    rows = stored(rows.withColumn("dim", F.size("v")).dropDuplicates(["dim", "id", "v"]), "vectors")
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") % every == 0).alias("nq"))
    plan = sizes.where("nq > 0").select("dim", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"),
                                        F.ceil(F.col("nq") / query_rows).cast("int").alias("parts"))
    # one small row per vector length; a query meets every block, a block every part of the queries
    each = rows.join(plan, "dim")
    base = each.select("dim", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"), "id", "v",
                       F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    ask = each.where(F.col("id") % every == 0).select(
        F.col("dim").alias("qdim"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("qblock"),
        F.col("id").alias("qid"), F.col("v").alias("qv"), F.pmod(F.xxhash64("id", F.lit(1)), "parts").cast("int").alias("qpart"))
    quantile = chi2_quantile(confidence, m)

    def search(b: pa.Table, q: pa.Table) -> pa.Table:
        if not len(b) or not len(q):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

        def matrix(column):
            flat = pa.concat_arrays([c.flatten() for c in column.chunks])
            return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)

        qid, vid, dist = search_block(b["id"].to_numpy(), matrix(b["v"]), q["qid"].to_numpy(), matrix(q["qv"]), k, m, quantile, seed)
        return pa.table({"query_id": qid, "vec_id": vid, "score": dist})

    found = base.groupBy("dim", "block", "part").cogroup(ask.groupBy("qdim", "qblock", "qpart")).applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.dropDuplicates(["query_id", "vec_id", "score"])
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
