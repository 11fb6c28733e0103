"""Repertoire analytics over long match tables ``(sample, sequence, count)``.

Everything stays long: the sample x sequence matrix is only widened on
request for a bounded column list (top-N), otherwise it is a sparse vector
per sample.  All aggregations are partial (map-side) before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repflow.functions.scalar import log10_plus1
from repflow.operators.sequence import is_productive
from repflow.schema import col_ref, validate_columns


def richness(matches: DataFrame, sample: str = "sample", seq: str = "CDR3_match",
             name: str = "Unique_CDR3_Count", approx: bool = False) -> DataFrame:
    """AGG-1: distinct sequences per sample (nulls ignored).

    Exact ``count_distinct`` shuffles on ``(sample, seq)`` after a map-side
    distinct, so one huge sample is spread over many tasks; ``approx`` uses
    HyperLogLog sketches instead.
    """
    validate_columns(matches, [sample, seq], "match table")
    s, q = F.col(col_ref(sample)), F.col(col_ref(seq))
    if approx:
        return matches.groupBy(s).agg(F.approx_count_distinct(q).cast("bigint").alias(name))
    # two-phase distinct: dedupe (sample, seq) across the cluster, then count
    d = matches.select(s.alias("__s"), q.alias("__q")).where(F.col("__q").isNotNull()).distinct()
    return d.groupBy(F.col("__s").alias(sample)).agg(F.count(F.lit(1)).alias(name))


def richness_summary(matches: DataFrame, tissue: str = "Tissue", sample: str = "sample",
                     seq: str = "CDR3_match") -> DataFrame:
    """AGG-15: richness, its log10(x+1) and the tissue of each sample."""
    validate_columns(matches, [tissue], "match table")
    st = matches.select(sample, tissue).distinct()
    r = richness(matches, sample, seq)
    out = r.join(st, sample, "left")
    return out.withColumn("Log_Value", log10_plus1(F.col("Unique_CDR3_Count")))


def length_spectrum(matches: DataFrame, mode: str = "total", sample: str = "sample",
                    seq: str = "CDR3_match", lo: int = 5, hi: int = 30) -> DataFrame:
    """AGG-9 + SEQ-8 + FLT-2: histogram of sequence lengths ``lo < len < hi``.

    ``mode='unique'`` de-duplicates sequences within each sample first (not
    globally), as the reference does per file.
    """
    df = matches.select(F.col(col_ref(sample)).alias("__s"), F.col(col_ref(seq)).alias("__q"))
    if mode == "unique":
        df = df.distinct()
    elif mode != "total":
        raise ValueError("mode must be 'total' or 'unique'")
    ln = F.length("__q")
    return df.where((ln > lo) & (ln < hi)).groupBy(ln.cast("int").alias("length")) \
        .agg(F.count(F.lit(1)).alias("n"))


def sequence_counts(matches: DataFrame, sample: str = "sample", seq: str = "CDR3_match",
                    count: str = "count") -> DataFrame:
    """AGG-2: summed ``count`` per (sample, sequence); null sequence dropped, all-null sum -> 0."""
    return matches.where(F.col(col_ref(seq)).isNotNull()).groupBy(
        F.col(col_ref(sample)).alias("sample"), F.col(col_ref(seq)).alias("sequence")) \
        .agg(F.coalesce(F.sum(F.col(col_ref(count))), F.lit(0)).cast("bigint").alias("count"))


def productive(long: DataFrame, seq: str = "sequence") -> DataFrame:
    """SEQ-9 applied to a long table."""
    return long.where(is_productive(F.col(col_ref(seq))))


def prevalence(long: DataFrame, seq: str = "sequence", sample: str = "sample") -> DataFrame:
    """AGG-3: number of distinct samples per sequence."""
    d = long.select(F.col(col_ref(seq)).alias("sequence"), F.col(col_ref(sample)).alias("__s")).distinct()
    return d.groupBy("sequence").agg(F.count(F.lit(1)).alias("n_samples"))


def top_sequences(long: DataFrame, n: int = 600) -> DataFrame:
    """TOP-1: the ``n`` most prevalent sequences; ties keep the smallest sequence."""
    return prevalence(long).orderBy(F.desc("n_samples"), F.asc("sequence")).limit(n)


def depth(long: DataFrame) -> DataFrame:
    """AGG-4: total count per sample."""
    return long.groupBy("sample").agg(F.sum("count").cast("bigint").alias("depth"))


def normalise_by_depth(long: DataFrame) -> DataFrame:
    """PVT-2 / JN-14 / WIN-2: ``value = count / total`` of the sample (0 where the total is 0).

    Totals are partial sums, one row per sample, joined back; no sample is gathered in one task.
    """
    total = long.groupBy(F.col("sample").alias("__s")).agg(F.sum("count").alias("__total"))
    return long.join(total, F.col("sample").eqNullSafe(F.col("__s"))).withColumn(
        "value", F.coalesce(F.try_divide(F.col("count"), F.col("__total")), F.lit(0.0))).drop("__s", "__total")


def restrict_to(long: DataFrame, top: DataFrame) -> DataFrame:
    """JN-15: keep rows whose sequence is in the (bounded, top-N) list: broadcast semi join."""
    return long.join(F.broadcast(top.select("sequence")), "sequence", "left_semi")


def feature_matrix_long(matches: DataFrame, top_n: int = 600, normalise: bool = False,
                        sample: str = "sample", seq: str = "CDR3_match", count: str = "count") -> DataFrame:
    """PVT-1/PVT-2 in long (sparse) form: ``sample, sequence, value``.

    v1 (``normalise=False``): raw summed counts of productive sequences.
    v2 (``normalise=True``): count / total over productive rows, computed
    before the top-N restriction.
    """
    long = productive(sequence_counts(matches, sample, seq, count))
    if normalise:
        long = normalise_by_depth(long)
    else:
        long = long.withColumn("value", F.col("count").cast("double"))
    top = top_sequences(long, top_n)
    return restrict_to(long, top).select("sample", "sequence", "value")


def pivot_matrix(long: DataFrame, columns: list[str]) -> DataFrame:
    """PVT-1 wide form for a bounded, explicit column list; missing cells are 0."""
    wide = long.groupBy("sample").pivot("sequence", columns).agg(F.first("value"))
    return wide.fillna(0.0, subset=columns)


def indexed_entries(long: DataFrame, top: DataFrame) -> tuple[DataFrame, int]:
    """PVT-1 scale path: ``(sample, indices, values)`` over the top-N index, and N.

    Column ids are the sequence ranks in ``top`` (bounded by N, broadcast); each
    sample's stored entries (at most N) are gathered by one grouped aggregate.
    """
    names = top.orderBy(F.desc("n_samples"), F.asc("sequence")).select("sequence").collect()     # N names
    idx = long.sparkSession.createDataFrame([(r["sequence"], i) for i, r in enumerate(names)], "sequence string, j int")
    cells = F.array_sort(F.collect_list(F.struct("j", F.col("value").cast("double").alias("value"))))
    rows = long.join(F.broadcast(idx), "sequence").groupBy("sample").agg(cells.alias("c"))
    return rows.select("sample", F.transform("c", lambda c: c["j"]).alias("indices"), F.transform("c", lambda c: c["value"]).alias("values")), len(names)


def sparse_vectors(long: DataFrame, top: DataFrame) -> DataFrame:
    """PVT-1 for ``pyspark.ml``: one vector of N values per sample, from :func:`indexed_entries` (a batch at a time)."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql.functions import arrow_udf

    rows, size = indexed_entries(long, top)

    @arrow_udf("array<double>")
    def spread_out(j: pa.Array, v: pa.Array) -> pa.Array:
        out = np.zeros((len(j), size))
        out[np.repeat(np.arange(len(j)), np.diff(j.offsets.to_numpy())), j.flatten().to_numpy()] = v.flatten().to_numpy()
        return pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, size, dtype=np.int32)), pa.array(out.ravel()))

    return rows.select("sample", array_to_vector(spread_out("indices", "values")).alias("features"))


def pair_samples(dict_a: DataFrame, dict_b: DataFrame) -> DataFrame:
    """JN-12: pair each assay-A sample with the first assay-B sample of the same
    patient and (case-insensitive) sample type; unmatched -> null partner."""
    a = dict_a.select(F.col("srx").alias("srx_a"), "patient", F.lower("sample_type").alias("__t"),
                      F.col("sample_type"), F.col("ord").alias("ord_a"))
    b = dict_b.select(F.col("srx").alias("srx_b"), F.col("patient").alias("__pb"),
                      F.lower("sample_type").alias("__tb"), F.col("ord").alias("ord_b"))
    j = a.join(b, (a["patient"] == b["__pb"]) & (a["__t"] == b["__tb"]), "left")
    w = Window.partitionBy("srx_a").orderBy(F.col("ord_b").asc_nulls_last())
    j = j.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
    return j.select("srx_a", "srx_b", "patient", "sample_type", "ord_a")


def overlap_report(set_a: DataFrame, set_b: DataFrame, pairs: DataFrame) -> DataFrame:
    """SET-4: per pair: |A|, |B|, |A and B| (distinct sequences); missing side -> 0.

    ``set_a``/``set_b`` are ``(srx, cdr3)``; both are de-duplicated before any
    join so each sample's set is counted once.
    """
    a = set_a.select("srx", "cdr3").where(F.col("cdr3").isNotNull()).distinct()
    b = set_b.select("srx", "cdr3").where(F.col("cdr3").isNotNull()).distinct()
    na = a.groupBy(F.col("srx").alias("srx_a")).agg(F.count(F.lit(1)).alias("n_a"))
    nb = b.groupBy(F.col("srx").alias("srx_b")).agg(F.count(F.lit(1)).alias("n_b"))
    pa = pairs.select("srx_a", "srx_b")
    shared = a.join(pa, a["srx"] == pa["srx_a"]).join(
        b.withColumnRenamed("srx", "__sb").withColumnRenamed("cdr3", "__cb"),
        (F.col("srx_b") == F.col("__sb")) & (F.col("cdr3") == F.col("__cb"))) \
        .groupBy("srx_a").agg(F.count(F.lit(1)).alias("n_shared"))
    out = pairs.join(na, "srx_a", "left").join(nb, "srx_b", "left").join(shared, "srx_a", "left")
    return out.select("srx_a", "srx_b", "patient", "sample_type",
                      F.coalesce("n_a", F.lit(0)).cast("bigint").alias("n_a"),
                      F.coalesce("n_b", F.lit(0)).cast("bigint").alias("n_b"),
                      F.coalesce("n_shared", F.lit(0)).cast("bigint").alias("n_shared"))
