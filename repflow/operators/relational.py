"""Relational helpers with pandas-compatible semantics made explicit.

pandas joins match null keys to each other and keeps "first" rows by file
order; Spark has neither implicitly.  Each helper states which it does:
``null_safe`` joins use ``<=>``; "first" always means smallest value of an
explicit ordinal column, never ``dropDuplicates`` (nondeterministic).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repflow.schema import col_ref, validate_columns


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """SRC-9: prefix every column name (``vdj_``, ``IgBlast_``)."""
    return df.toDF(*[prefix + c for c in df.columns])


def join_keys(left: DataFrame, right: DataFrame, keys, how: str = "inner",
              null_safe: bool = False, suffixes=("_x", "_y")) -> DataFrame:
    """JN-1/JN-2/JN-5: join on same-named keys, pandas-style.

    Key columns appear once (coalesced for outer joins); other colliding names
    get ``suffixes``.  ``null_safe`` makes null keys match each other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    validate_columns(left, keys, "left")
    validate_columns(right, keys, "right")
    common = (set(left.columns) & set(right.columns)) - set(keys)
    lr = left.select(*[F.col(col_ref(c)).alias(f"__l_{c}" if c in keys else (c + suffixes[0] if c in common else c))
                       for c in left.columns])
    rr = right.select(*[F.col(col_ref(c)).alias(f"__r_{c}" if c in keys else (c + suffixes[1] if c in common else c))
                        for c in right.columns])
    cond = reduce(lambda a, b: a & b, [
        (F.col(f"__l_{k}").eqNullSafe(F.col(f"__r_{k}")) if null_safe else F.col(f"__l_{k}") == F.col(f"__r_{k}"))
        for k in keys])
    j = lr.join(rr, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return j.select(*[F.col(f"__l_{c}").alias(c) if c in keys
                          else F.col(col_ref(c + suffixes[0] if c in common else c)).alias(c)
                          for c in left.columns])
    key_cols = []
    for k in keys:
        if how in ("right", "right_outer"):
            key_cols.append(F.col(f"__r_{k}").alias(k))
        elif how in ("full", "outer", "full_outer"):
            key_cols.append(F.coalesce(F.col(f"__l_{k}"), F.col(f"__r_{k}")).alias(k))
        else:
            key_cols.append(F.col(f"__l_{k}").alias(k))
    rest = [F.col(col_ref(c)) for c in j.columns if not c.startswith("__l_") and not c.startswith("__r_")]
    return j.select(*key_cols, *rest)


def keep_first(df: DataFrame, keys, order_col: str) -> DataFrame:
    """DED-1 / WIN-1: the first row per key by an explicit ordinal.

    ``min_by`` is a partial (map-side) aggregate, so a key holding a large share
    of the rows is reduced before the shuffle instead of being sorted in one
    task.  One ``min_by`` per column, all of the same row: numbers then need no
    sort of the rows (a struct would).  Output: key columns first, then the others.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*[F.col(col_ref(k)) for k in keys]).agg(
        *[F.min_by(F.col(col_ref(c)), F.col(col_ref(order_col))).alias(c) for c in others])
    return agg.select(*[F.col(col_ref(c)) for c in [*keys, *others]])


def first_containing(samples: DataFrame, sample_col: str, ids: DataFrame, id_col: str,
                     order_col: str, out_col: str = "matched_id") -> DataFrame:
    """JN-3: for each sample, the first id (by ``order_col``) that is a substring of it.

    Exact containment as an equi-join (no nested loop): every substring of the
    sample name whose length is one of the ids' lengths is joined with the ids
    on the full string, then ``min_by`` keeps the earliest id.  The distinct id
    lengths are one small aggregate (an id never exceeds a file name).
    Unmatched samples get null.
    """
    s = samples.select(F.col(col_ref(sample_col)).alias("__s")).distinct()
    i = ids.select(F.col(col_ref(id_col)).cast("string").alias("__id"), F.col(col_ref(order_col)).alias("__o")) \
        .where(F.col("__id").isNotNull() & (F.length("__id") > 0))
    lengths = [r[0] for r in i.select(F.length("__id")).distinct().collect()]   # bounded by name length
    n = F.length("__s")

    def cut(length):           # one-argument lambda (a second one would mean the index)
        return lambda p: F.substring(F.col("__s"), p, length)

    windows = F.flatten(F.array(*[
        F.transform(F.when(n >= L, F.sequence(F.lit(1), n - L + 1)).otherwise(F.array().cast("array<int>")),
                    cut(L)) for L in lengths])) if lengths else F.array().cast("array<string>")
    w = s.select("__s", F.explode_outer(F.array_distinct(windows)).alias("__w"))
    j = w.join(i, w["__w"] == i["__id"], "left")
    return j.groupBy("__s").agg(F.min_by("__id", "__o").alias(out_col)).withColumnRenamed("__s", sample_col)


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """AGG-11: rows per value (nulls form their own group), most frequent first."""
    return df.groupBy(F.col(col_ref(col))).agg(F.count(F.lit(1)).alias(name)) \
        .orderBy(F.desc(name), F.col(col_ref(col)))


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """AGG-13: one row: total rows and null count per column (long form)."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(col_ref(c)).isNull()).alias(f"__null_{i}") for i, c in enumerate(cols)])
    stack = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__null_{i}").alias("n_null"))
                               for i, c in enumerate(cols)]))
    return agg.select(F.col("__n").alias("n_rows"), stack)


def describe_exact(df: DataFrame, value: str, by=(), approx: bool = False) -> DataFrame:
    """AGG-7: count, mean, sample std, min, quartiles, max per group.

    Exact quartiles come from :func:`repflow.operators.quantiles.exact_quantiles`, which never
    gathers a group; ``approx=True`` uses mergeable quantile sketches in one pass instead.
    """
    from repflow.operators.quantiles import exact_quantiles

    v, by = F.col(col_ref(value)).cast("double"), list(by)
    keys = [F.col(col_ref(b)).alias(b) for b in by]
    sums = [F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min")]
    if approx:
        q = [F.percentile_approx(v, p, 10000).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
        return df.groupBy(*keys).agg(*sums, *q, F.max(v).alias("max"))
    s = df.groupBy(*keys).agg(*sums, F.max(v).alias("max"))
    t = exact_quantiles(df.select(*keys, v.alias("__value")), by, "__value", (0.25, 0.5, 0.75), ("q25", "q50", "q75"))
    t = t.select(*[F.col(col_ref(b)).alias(f"__k{i}") for i, b in enumerate(by)], "q25", "q50", "q75")
    # without groups both sides are one row
    on = reduce(lambda x, y: x & y, [F.col(col_ref(b)).eqNullSafe(F.col(f"__k{i}")) for i, b in enumerate(by)], F.lit(True)) if by else None
    j = s.join(t, on) if by else s.withColumn("__j", F.lit(1)).join(F.broadcast(t.withColumn("__j", F.lit(1))), "__j")
    return j.select(*[F.col(col_ref(b)) for b in by], "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def flag_membership(df: DataFrame, ref: DataFrame, keys, ref_keys=None, flag: str = "is_in") -> DataFrame:
    """JN-9: boolean column: is the (null-safe) key tuple present in ``ref``?

    ``ref`` is reduced to its distinct key tuples first (pre-aggregation before
    the join), so a heavy key in ``ref`` cannot fan rows out.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ref_keys = list(ref_keys or keys)
    r = ref.select(*[F.col(col_ref(rk)).alias(f"__k{i}") for i, rk in enumerate(ref_keys)]).distinct() \
        .withColumn("__hit", F.lit(True))
    cond = reduce(lambda a, b: a & b, [F.col(col_ref(k)).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    j = df.join(r, cond, "left")
    return j.select(*[F.col(col_ref(c)) for c in df.columns],
                    F.coalesce(F.col("__hit"), F.lit(False)).alias(flag))


def target_guard(df: DataFrame, col: str, max_null_fraction: float = 0.5) -> DataFrame:
    """FLT-7: ``n_rows, n_null, n_distinct, ok`` for a target column.

    ``ok`` is false when the column is more than half null.  Raises at plan
    time when the column is missing.
    """
    validate_columns(df, [col], "metadata")
    c = F.col(col_ref(col))
    s = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(c.isNull()).alias("n_null"),
               F.count_distinct(c).alias("n_distinct"))
    return s.withColumn("ok", F.col("n_null") <= F.col("n_rows") * max_null_fraction)


def require_target(df: DataFrame, col: str, max_null_fraction: float = 0.5) -> DataFrame:
    """FLT-7 as a stop: the report of :func:`target_guard`, with ``few_classes`` (2 to 4 distinct values).

    ``ValueError`` if the column is missing, more than ``max_null_fraction`` of it is null, or it has no value at all.
    """
    report = target_guard(df, col, max_null_fraction)
    row = report.first()                                    # one row of counts
    if not row["ok"] or not row["n_distinct"]:
        raise ValueError(f"target {col!r}: {row['n_null']} of {row['n_rows']} values are null")
    return report.withColumn("few_classes", F.col("n_distinct").between(2, 4))


def drop_null_target(df: DataFrame, col: str, required: bool = False) -> DataFrame:
    """FLT-6: rows whose target is not null; with ``required`` a ``ValueError`` if none is left."""
    validate_columns(df, [col], "metadata")
    kept = df.where(F.col(col_ref(col)).isNotNull())
    if required and not kept.limit(1).count():
        raise ValueError(f"no row has a {col!r}")
    return kept


def align_metadata(samples: DataFrame, metadata: DataFrame, sample_col: str = "sample", key_col: str = "Run") -> DataFrame:
    """JN-13: the metadata rows of a matrix's samples, next to the sample (several rows of one key fan out).

    ``ValueError`` naming some samples if any has no metadata row; row order is by sample, as in the matrix.
    """
    s = samples.select(F.col(col_ref(sample_col)).alias("__sample")).distinct()
    missing = [r[0] for r in s.join(metadata, s["__sample"] == metadata[key_col], "left_anti").limit(5).collect()]
    if missing:
        raise ValueError(f"samples without metadata, for example {missing}")
    return s.join(metadata, s["__sample"] == metadata[key_col]).withColumnRenamed("__sample", sample_col).orderBy(sample_col)


def unique_per_group(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """AGG-10: distinct values per group, largest first."""
    return df.groupBy(F.col(col_ref(group))).agg(F.count_distinct(F.col(col_ref(value))).alias(name)) \
        .orderBy(F.desc(name), F.col(col_ref(group)))


def preview(df: DataFrame, order_by, n: int = 5) -> DataFrame:
    """LIM-1: first ``n`` rows under an explicit order."""
    order_by = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return df.orderBy(*order_by).limit(n)


def key_present(df: DataFrame, col: str, value) -> DataFrame:
    """FLT-8: one row ``present`` - is ``value`` in ``col``? (stops at the first hit)."""
    hit = df.where(F.col(col_ref(col)) == F.lit(value)).limit(1)
    return hit.agg(F.count(F.lit(1)).alias("n")).select((F.col("n") > 0).alias("present"))
