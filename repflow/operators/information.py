"""Mutual information of numbers and classes by nearest neighbours (ML-5).

Per feature, for a point of value ``x`` in a class of ``n_c`` points: ``r`` is the distance to its ``k``-th nearest
point of the class (``k`` at most ``n_c - 1``), ``m`` the number of points of any class nearer than ``r``, itself
included (with ``r = 0``: the points of equal value).  With ``psi`` the digamma function

    MI = psi(N) + mean psi(k) - mean psi(n_c) - mean psi(m),   not below 0,

over the ``N`` points whose class has more than one.  Equal values are told apart by a fixed jitter far below
the data's resolution, a hash of the row's id and the feature.

No feature and no class is ever in one task: ranks come from range partitions (ties split by a hash) with
offsets per partition; class neighbours are found in blocks of ranks that overlap by ``k`` rows; the counts ``m`` are
differences of two rank look-ups, answered by one sorted pass over points and look-ups together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repflow.operators.ml import HASH_MOD, HASH_MULT, SEED
from repflow.operators.ranks import running_before
from repflow.plans.partitioning import stored

JITTER = 1e-10
FEATURE_MULT = 40503
BLOCK_ROWS = 65_536


def digamma(n: Column) -> Column:
    """``psi(n)`` for ``n >= 1``: recurrence up to ``n + 10``, then the asymptotic series."""
    n = n.cast("double")
    x = n + 10.0
    y = 1.0 / (x * x)
    tail = F.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))
    for i in range(10):
        tail = tail - 1.0 / (n + float(i))
    return tail


def jittered(long: DataFrame, jitter: float = JITTER, seed: int = SEED) -> DataFrame:
    """``long(id, feature, x, y)`` without null, NaN or infinite ``x`` or null ``y``, equal values told apart.

    The step is ``jitter`` times the feature's mean absolute value (at least 1), times a number of mean 0 and
    variance 1 that is a fixed hash of id and feature (a number, or the feature's hash).
    """
    x = F.col("x").cast("double")
    d = long.select("id", "feature", x.alias("x"), "y").where("id IS NOT NULL AND feature IS NOT NULL AND y IS NOT NULL AND x IS NOT NULL") \
        .where(~F.isnan("x") & (F.abs("x") < float("inf")))
    if not jitter:
        return d
    number = F.col("feature").cast("long") if dict(d.dtypes)["feature"] in ("int", "bigint", "smallint", "tinyint") \
        else F.pmod(F.xxhash64("feature"), F.lit(HASH_MOD))
    h = F.pmod(F.pmod(F.col("id"), F.lit(1 << 30)) * HASH_MULT + F.pmod(number, F.lit(1 << 30)) * FEATURE_MULT + seed, F.lit(HASH_MOD))
    for _ in range(2):          # products of both halves: neighbours in id or feature get unrelated steps, no equal distances
        low, high = F.pmod(h, F.lit(65_536)), F.shiftright(h, 16)
        h = F.pmod(low * high * FEATURE_MULT + low * HASH_MULT + high, F.lit(HASH_MOD))
    scale = stored(d.groupBy("feature").agg(F.greatest(F.lit(1.0), F.round(F.avg(F.abs("x")), 6)).alias("__scale")))
    step = F.lit(jitter) * F.col("__scale") * ((h / float(HASH_MOD) - 0.5) * 3.4641016151377544)
    return d.join(scale, "feature").select("id", "feature", (F.col("x") + step).alias("x"), "y")


def class_distances(points: DataFrame, k: int) -> DataFrame:
    """``points(id, feature, x, y)`` with ``n_c``, ``k_c`` and the open interval ``(lo, hi)`` that the ``k_c``-th class neighbour bounds.

    ``flat`` marks radius 0.  Points alone in their class are left out.
    """
    ranked = running_before(points.withColumn("__salt", F.xxhash64("id")), ["feature", "y"], ["x", "__salt"], keep=["id", "x"])
    sizes = stored(ranked.groupBy("feature", "y").agg(F.count(F.lit(1)).alias("n_c")).where("n_c > 1"))
    b, at = F.floor(F.col("before") / BLOCK_ROWS), F.col("before") % BLOCK_ROWS
    own = ranked.join(sizes, ["feature", "y"]).withColumn("__b", F.explode(F.array_compact(F.array(
        b, F.when(at < k, b - 1), F.when(at >= BLOCK_ROWS - k, b + 1)))))
    kinds, block = dict(ranked.dtypes), BLOCK_ROWS
    return own.groupBy("feature", "y", "__b").applyInArrow(
        lambda t: _block_distances(t, k, block), ", ".join(f"`{c}` {kinds[c]}" for c in ("id", "feature", "x", "y"))
        + ", n_c long, k_c int, flat boolean, lo double, hi double")


def _block_distances(t: pa.Table, k: int, block: int) -> pa.Table:
    """One block of ranks of a class, its overlap left out again, with the open interval that each row's ``k``-th neighbour bounds."""
    t = t.sort_by("before")
    x, n_c = t["x"].to_numpy(), t["n_c"][0].as_py()
    kk, n = min(k, n_c - 1), len(t)
    r, lo, hi = (np.full(n, np.inf) for _ in range(3))
    found = np.zeros(n, bool)
    for j in range(kk + 1):                      # j neighbours below, the others above
        mid = slice(j, n - (kk - j))
        below, above, v = x[:n - kk], x[kk:], x[mid]
        if not len(v):
            continue
        left, right = v - below, above - v
        far = np.maximum(left, right)
        a, b = np.where(left >= right, below, v - far), np.where(right >= left, above, v + far)
        less = ~found[mid] | (far < r[mid]) | ((far == r[mid]) & ((a < lo[mid]) | ((a == lo[mid]) & (b < hi[mid]))))
        for kept, new in ((r, far), (lo, a), (hi, b)):
            kept[mid] = np.where(less, new, kept[mid])
        found[mid] = True
    t = t.append_column("k_c", pa.array(np.full(n, kk, np.int32))).append_column("flat", pa.array(r == 0))
    t = t.append_column("lo", pa.array(lo)).append_column("hi", pa.array(hi))
    own = t["before"].to_numpy() // block == t["__b"].to_numpy()
    return t.filter(pa.array(own)).select(["id", "feature", "x", "y", "n_c", "k_c", "flat", "lo", "hi"])


def mutual_information_knn(long: DataFrame, k: int = 3, jitter: float = JITTER, seed: int = SEED) -> DataFrame:
    """``(feature, mi)`` in nats for ``long(id, feature, x, y)``: integer ids, one row per id and feature.

    Rows with a null, NaN or infinite ``x`` or a null ``y`` are left out; a feature without two points of one class
    has ``mi`` 0.  An empty table gives no rows.
    """
    clean = jittered(stored(long.select("id", "feature", "x", "y")), jitter, seed)
    points = stored(class_distances(clean, k))
    one = F.lit(1)
    # look-ups: how many points lie at or below (kind 2), or below (kind 0), a value
    ask = [F.struct(F.when(F.col("flat"), F.col("x")).otherwise(F.col("hi")).alias("v"),
                    F.when(F.col("flat"), 2).otherwise(0).alias("kind"), one.alias("sign")),
           F.struct(F.when(F.col("flat"), F.col("x")).otherwise(F.col("lo")).alias("v"),
                    F.when(F.col("flat"), 0).otherwise(2).alias("kind"), (-one).alias("sign")),
           F.struct(F.col("x").alias("v"), one.alias("kind"), F.lit(0).alias("sign"))]
    events = points.select("id", "feature", F.explode(F.array(*ask)).alias("e")).select(
        "id", "feature", "e.v", "e.kind", "e.sign", (F.col("e.kind") == 1).cast("int").alias("point"), F.xxhash64("id").alias("__salt"))
    ranked = running_before(events, ["feature"], ["v", "kind", "__salt"], "point", keep=["id", "kind", "sign"]).where("kind <> 1")
    m = ranked.groupBy("feature", "id").agg(F.sum(F.col("sign") * F.col("before")).alias("m"))
    n_m = m.groupBy("feature").agg(F.avg(digamma(F.col("m"))).alias("psi_m"))
    rest = points.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.avg(digamma(F.col("k_c"))).alias("psi_k"), F.avg(digamma(F.col("n_c"))).alias("psi_c"))
    mi = digamma(F.col("n")) + F.col("psi_k") - F.col("psi_c") - F.col("psi_m")
    told = rest.join(n_m, "feature").select("feature", F.greatest(mi, F.lit(0.0)).alias("mi"))
    return clean.select("feature").distinct().join(told, "feature", "left").select("feature", F.coalesce("mi", F.lit(0.0)).alias("mi"))
