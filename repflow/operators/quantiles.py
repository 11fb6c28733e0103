"""Exact quantiles per group without a group in one buffer (AGG-5, AGG-7, AGG-8, ML-2).

Where a wanted rank lies is found by histograms: a pass counts each group's values in equal-width bins between the
smallest and largest value that are still possible, keeps the bins that hold a wanted rank, with their smallest and
largest value, and goes on inside them.  After ``passes`` rounds only the values of those last bins are ordered, by
range partitions (:func:`repflow.operators.ranks.running_before`), equal values counted together.  The counts are
partial sums, so a group of any share of the rows is spread over all tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repflow.operators.ranks import running_before
from repflow.plans.partitioning import materialize

BINS = 1024


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])


def exact_quantiles(df: DataFrame, by, value, probs, names=None, bins: int = BINS, passes: int = 2) -> DataFrame:
    """One row per group of ``by``: its columns, and per probability the quantile, interpolated between neighbours.

    Null and NaN values are left out; a group without any other value has null quantiles; null group keys are a
    group.  Without ``by`` one row, also for an empty table.
    """
    by, probs = list(by), [float(p) for p in probs]
    names = list(names or [f"q{i}" for i in range(len(probs))])
    keys = [f"__g{i}" for i in range(len(by))] or ["__g0"]
    group = [F.col(b).alias(k) if isinstance(b, str) else b.alias(k) for b, k in zip(by, keys)] or [F.lit(0).alias("__g0")]
    v = F.col(value).cast("double") if isinstance(value, str) else value.cast("double")
    rows = materialize(df.select(*group, v.alias("__v")))          # keys and values, read by every pass
    groups = rows.select(*keys).distinct() if by else df.sparkSession.range(1).select(F.lit(0).alias("__g0"))
    rows = rows.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    h = [(F.col("n") - 1) * p for p in probs]
    ranks = F.array_distinct(F.array(*[F.floor(x) for x in h], *[F.ceil(x) for x in h]))
    stats = materialize(rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi")))
    spans = stats.select(*keys, "lo", "hi", F.lit(0).cast("long").alias("below"), ranks.alias("ranks"))
    found = None

    def settle(s):
        """Spans of one value give all of their ranks."""
        nonlocal found
        s = materialize(s)
        one = s.where("lo = hi").select(*keys, F.explode("ranks").alias("rank"), F.col("lo").alias("value"))
        found = one if found is None else found.unionByName(one)
        return materialize(s.where("lo < hi").withColumn("__span", F.monotonically_increasing_id()))

    for _ in range(passes):
        spans = settle(spans)
        at = rows.join(spans, _same(rows, spans, keys) & (rows["__v"] >= spans["lo"]) & (rows["__v"] <= spans["hi"]))
        share = (F.col("__v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        bin_ = F.when(F.isnan(share), bins - 1).otherwise(F.least(F.floor(share * bins), F.lit(bins - 1)))
        counts = at.groupBy("__span", bin_.alias("__bin")).agg(F.count("*").alias("c"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
        run = Window.partitionBy("__span").orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)       # at most ``bins`` rows
        counts = counts.withColumn("first", F.sum("c").over(run) - F.col("c"))
        held = counts.join(spans.select("__span", *keys, F.col("below").alias("__below"), F.col("ranks").alias("__ranks")), "__span")
        below = F.col("__below") + F.col("first")
        inside = F.filter("__ranks", lambda r: (r >= below) & (r < below + F.col("c")))
        spans = held.select(*keys, "lo", "hi", below.alias("below"), inside.alias("ranks")).where(F.size("ranks") > 0)
    spans = settle(spans)
    at = rows.join(spans, _same(rows, spans, keys) & (rows["__v"] >= spans["lo"]) & (rows["__v"] <= spans["hi"]))
    order = running_before(at.groupBy("__span", "__v").agg(F.count("*").alias("c")), ["__span"], ["__v"], "c")
    last = order.join(spans.select("__span", *keys, "below", "ranks"), "__span").withColumn("__from", F.col("below") + F.col("before"))
    last = last.select(*keys, F.explode(F.filter("ranks", lambda r: (r >= F.col("__from")) & (r < F.col("__from") + F.col("c")))).alias("rank"),
                       F.col("__v").alias("value"))
    table = found.unionByName(last).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("__at"))
    told = stats.join(table, _same(stats, table, keys)).select(*[stats[k] for k in keys], "n", "__at")

    def quantile(p):
        x = (F.col("n") - 1) * p
        a, b = F.col("__at")[F.floor(x)], F.col("__at")[F.ceil(x)]
        return F.when(a == b, a).otherwise(a + (b - a) * (x - F.floor(x)))

    told = told.select(*keys, *[quantile(p).alias(n) for p, n in zip(probs, names)])
    out = groups.join(told, _same(groups, told, keys), "left")
    return out.select(*[groups[k].alias(b if isinstance(b, str) else f"group{i}") for i, (k, b) in enumerate(zip(keys, by))], *names)
