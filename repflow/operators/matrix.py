"""Sparse expression-matrix operators on coordinate form ``(cell, gene, value)``.

Only non-zero entries are stored.  Statistics that depend on the implicit
zeros (means, variances, ranks) use sums plus the cell count instead of
densifying; the only dense step is the per-cell vector for PCA, limited to
the selected (highly variable) genes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repflow.functions.scalar import is_mito

# --- fixed values: defaults of the reference calls --------------------------
MIN_GENES = 200
MIN_CELLS = 3
MAX_PCT_MITO = 20.0
TARGET_SUM = 1e4
HVG_MIN_MEAN, HVG_MAX_MEAN, HVG_MIN_DISP, HVG_BINS = 0.0125, 3.0, 0.5, 20
SCALE_MAX = 10.0
MAX_MODEL = 20_000_000          # rows of a typing model: genes x types, genes x reference samples
# ---------------------------------------------------------------------------


def _one_row_join(df: DataFrame, one: DataFrame) -> DataFrame:
    """Attach a single-row aggregate to every row (broadcast, constant key)."""
    return df.withColumn("__k", F.lit(1)).join(F.broadcast(one.withColumn("__k", F.lit(1))), "__k").drop("__k")


def cell_qc(coo: DataFrame, mito_prefix: str = "MT-") -> DataFrame:
    """MAT-3 per cell: genes detected, total, mito total and percent."""
    v = F.col("value")
    return coo.groupBy("cell").agg(
        F.count_if(v > 0).alias("n_genes_by_counts"), F.sum(v).alias("total_counts"),
        F.sum(F.when(is_mito(F.col("gene"), mito_prefix), v).otherwise(0.0)).alias("total_counts_mt"),
    ).withColumn("pct_counts_mt", F.coalesce(F.try_divide(F.col("total_counts_mt") * 100.0, F.col("total_counts")),
                                             F.lit(float("nan"))))        # a cell of total 0 passes no percentage filter


def gene_qc(coo: DataFrame) -> DataFrame:
    """MAT-3 per gene: cells detected, mean over all cells (zeros included), total."""
    n_cells = coo.select("cell").distinct().agg(F.count(F.lit(1)).alias("__n"))
    g = coo.groupBy("gene").agg(F.count_if(F.col("value") > 0).alias("n_cells_by_counts"),
                                F.sum("value").alias("total_counts"))
    return _one_row_join(g, n_cells).select(
        "gene", "n_cells_by_counts", (F.col("total_counts") / F.col("__n")).alias("mean_counts"), "total_counts")


def filter_cells(coo: DataFrame, min_genes: int = MIN_GENES) -> DataFrame:
    """MAT-1: keep cells with at least ``min_genes`` detected genes."""
    keep = coo.groupBy("cell").agg(F.count_if(F.col("value") > 0).alias("n")).where(F.col("n") >= min_genes)
    return coo.join(keep.select("cell"), "cell", "left_semi")


def filter_genes(coo: DataFrame, min_cells: int = MIN_CELLS) -> DataFrame:
    """MAT-2: keep genes detected in at least ``min_cells`` cells."""
    keep = coo.groupBy("gene").agg(F.count_if(F.col("value") > 0).alias("n")).where(F.col("n") >= min_cells)
    return coo.join(keep.select("gene"), "gene", "left_semi")


def filter_mito(coo: DataFrame, max_pct: float = MAX_PCT_MITO, mito_prefix: str = "MT-") -> DataFrame:
    """MAT-4: keep cells whose mito percentage is below ``max_pct``."""
    keep = cell_qc(coo, mito_prefix).where(F.col("pct_counts_mt") < max_pct).select("cell")
    return coo.join(keep, "cell", "left_semi")


def preprocess(coo: DataFrame, min_genes: int = MIN_GENES, min_cells: int = MIN_CELLS,
               max_pct: float = MAX_PCT_MITO) -> DataFrame:
    """MAT-1 -> MAT-2 -> MAT-4 in the reference order."""
    return filter_mito(filter_genes(filter_cells(coo, min_genes), min_cells), max_pct)


def normalise_total(coo: DataFrame, target: float = TARGET_SUM) -> DataFrame:
    """MAT-5: scale each cell to ``target`` total (window sum per cell, no join back); a cell of total 0 stays as it is."""
    total = F.sum("value").over(Window.partitionBy("cell"))
    return coo.withColumn("value", F.coalesce(F.try_divide(F.col("value") * target, total), F.col("value").cast("double")))


def log1p(coo: DataFrame) -> DataFrame:
    """MAT-6."""
    return coo.withColumn("value", F.log1p("value"))


def highly_variable_genes(logged: DataFrame, min_mean: float = HVG_MIN_MEAN, max_mean: float = HVG_MAX_MEAN,
                          min_disp: float = HVG_MIN_DISP, n_bins: int = HVG_BINS) -> DataFrame:
    """MAT-7: dispersion-based highly variable genes (binned, normalised dispersion).

    Per gene over all cells of expm1(value): mean m and sample variance from
    sums (zeros implicit); d = log(var/m), mean = log1p(m); equal-width bins of
    the mean (first edge lowered by 0.1 % of the range, right-closed); per bin
    mean and sample std of d; a bin with one gene gets std := its mean and
    mean := 0.  Selected when min_mean < mean < max_mean and z > min_disp.
    """
    x = F.expm1("value")
    n = logged.select("cell").distinct().agg(F.count(F.lit(1)).cast("double").alias("__n"))
    g = logged.groupBy("gene").agg(F.sum(x).alias("s1"), F.sum(x * x).alias("s2"))
    g = _one_row_join(g, n)
    m = F.col("s1") / F.col("__n")
    var = F.try_divide(F.col("s2") - F.col("__n") * m * m, F.col("__n") - 1)
    m_safe = F.when(m == 0, F.lit(1e-12)).otherwise(m)
    disp = var / m_safe
    g = g.select("gene", F.log1p(m_safe).alias("means"),
                 F.when(disp == 0, F.lit(None)).otherwise(F.log(disp)).alias("dispersions"))
    rng = g.agg(F.min("means").alias("__lo"), F.max("means").alias("__hi"))
    g = _one_row_join(g, rng)
    width = (F.col("__hi") - F.col("__lo")) / n_bins
    b = F.greatest(F.ceil(F.try_divide(F.col("means") - F.col("__lo"), width)) - 1, F.lit(0))
    g = g.withColumn("mean_bin", F.when(width > 0, b).otherwise(F.lit(0)).cast("int"))
    stats = g.groupBy("mean_bin").agg(F.avg("dispersions").alias("__bm"), F.stddev_samp("dispersions").alias("__bs"))
    stats = stats.select("mean_bin",
                         F.when(F.col("__bs").isNull(), F.lit(0.0)).otherwise(F.col("__bm")).alias("__bm"),
                         F.when(F.col("__bs").isNull(), F.col("__bm")).otherwise(F.col("__bs")).alias("__bs"))
    g = g.join(F.broadcast(stats), "mean_bin", "left")  # at most n_bins rows
    z = F.try_divide(F.col("dispersions") - F.col("__bm"), F.col("__bs"))      # no spread in the bin: not variable
    g = g.withColumn("dispersions_norm", z)
    hv = (F.col("means") > min_mean) & (F.col("means") < max_mean) & (F.col("dispersions_norm") > min_disp)
    return g.select("gene", "means", "dispersions", "mean_bin", "dispersions_norm",
                    F.coalesce(hv, F.lit(False)).alias("highly_variable"))


def subset_genes(coo: DataFrame, genes: DataFrame) -> DataFrame:
    """MAT-9: keep entries of the selected genes (left semi join)."""
    return coo.join(genes.select("gene"), "gene", "left_semi")


def scale(coo: DataFrame, max_value: float = SCALE_MAX, clip_low: bool = True, cells: DataFrame | None = None):
    """MAT-10: per-gene z-score over all cells (zeros included), clipped.

    Returns ``(entries, zeros)``: ``entries`` holds the scaled value of every
    stored entry; ``zeros`` holds, per gene, the scaled value every cell
    without an entry takes.  Together they are the dense scaled matrix
    without materialising cells x genes.  ``cells`` lists every cell of the
    matrix (a gene subset may have dropped some cells' last entries).
    """
    n = (cells if cells is not None else coo).select("cell").distinct().agg(F.count(F.lit(1)).cast("double").alias("__n"))
    g = _one_row_join(coo.groupBy("gene").agg(F.sum("value").alias("s1"), F.sum(F.col("value") ** 2).alias("s2")), n)
    mean = F.col("s1") / F.col("__n")
    sd = F.sqrt(F.greatest((F.col("s2") - F.col("__n") * mean * mean) / (F.col("__n") - 1), F.lit(0.0)))
    g = g.select("gene", mean.alias("__mean"), F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias("__sd"))

    def clip(c):
        c = F.least(c, F.lit(max_value))
        return F.greatest(c, F.lit(-max_value)) if clip_low else c

    entries = coo.join(g, "gene").select("cell", "gene", clip((F.col("value") - F.col("__mean")) / F.col("__sd")).alias("value"))
    zeros = g.select("gene", clip(-F.col("__mean") / F.col("__sd")).alias("value"))
    return entries, zeros


def _vectors(coo: DataFrame, names: list[str]) -> DataFrame:
    """``(cell, g, v)``: per cell the numbers (in ``names``) and values of its known genes (one entry per cell and gene)."""
    index = coo.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "gene string, g int")      # genes of the model
    rows = coo.join(F.broadcast(index), "gene").select("cell", "g", F.col("value").cast("double").alias("v"))
    rows = rows.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("g", "v"))).alias("x"))
    return rows.select("cell", F.transform("x", lambda x: x["g"]).alias("g"), F.transform("x", lambda x: x["v"]).alias("v"))


def _bounded(df: DataFrame, what: str) -> list:
    """The rows of a model table, at most ``MAX_MODEL`` of them."""
    rows = df.limit(MAX_MODEL + 1).collect()
    if len(rows) > MAX_MODEL:
        raise ValueError(f"{what} has more than {MAX_MODEL} rows")
    return rows


def type_scores(logged: DataFrame, weights: DataFrame, intercepts: DataFrame) -> DataFrame:
    """MAT-14: per cell and type: sigmoid(sum of weight x value + intercept); best type per cell.

    ``weights(gene, cell_type, weight)``, ``intercepts(cell_type, intercept)`` are
    model tables (at most ``MAX_MODEL`` rows).  A cell is one sparse vector over the model's genes, multiplied with the
    genes x types matrix a batch at a time; cells without any of the genes are left out.  A type without an
    intercept has 0; probabilities equal to 9 decimals are ties, broken by type name.
    """
    from repflow.operators.spectral import _entries, _products

    w = [r for r in _bounded(weights.select("gene", "cell_type", F.col("weight").cast("double")), "the weights") if None not in r]
    types, genes = sorted({r[1] for r in w}), sorted({r[0] for r in w})
    b = {r[0]: r[1] for r in _bounded(intercepts.select("cell_type", F.col("intercept").cast("double")), "the intercepts")}
    m = np.zeros((len(genes), len(types)))
    at_gene, at_type = {g: i for i, g in enumerate(genes)}, {t: i for i, t in enumerate(types)}
    for gene, kind, value in w:
        m[at_gene[gene], at_type[kind]] += value
    shift = np.array([b.get(t) or 0.0 for t in types])
    shared = logged.sparkSession.sparkContext.broadcast(m)

    def to_best(batches):
        for x in batches:
            prob = 1.0 / (1.0 + np.exp(-(_products(*_entries(x), shared.value) + shift)))
            best = np.round(prob, 9).argmax(1) if len(types) else np.zeros(0, int)
            yield pa.record_batch([x.column("cell"), pa.array(np.array(types, object)[best], pa.string()), pa.array(prob[np.arange(len(best)), best])],
                                  names=["cell", "predicted_labels", "prob"])

    cells = _vectors(logged, genes)
    return cells.mapInArrow(to_best, cells.select("cell").schema.add("predicted_labels", "string").add("prob", "double"))


def majority_vote(labels: DataFrame, clusters: DataFrame) -> DataFrame:
    """MAT-15: every cell takes its cluster's most common label (ties: smallest label)."""
    j = labels.join(clusters, "cell")
    c = j.groupBy("cluster", "predicted_labels").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("cluster").orderBy(F.desc("__n"), F.asc("predicted_labels"))
    top = c.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").select(
        "cluster", F.col("predicted_labels").alias("majority_voting"))
    return j.join(top, "cluster").select("cell", "cluster", "predicted_labels", "majority_voting")


def _avg_ranks(df: DataFrame, part: str, n_total: DataFrame | None = None) -> DataFrame:
    """Average-tie ranks of ``value`` within ``part`` (1-based, ascending)."""
    w = Window.partitionBy(part).orderBy("value")
    wv = Window.partitionBy(part, "value")
    r = df.withColumn("__r", F.rank().over(w)).withColumn("__c", F.count(F.lit(1)).over(wv))
    return r.withColumn("rank", F.col("__r") + (F.col("__c") - 1) / 2.0).drop("__r", "__c")


def spearman_typing(expr: DataFrame, ref: DataFrame, quantile: float = 0.8, tie_digits: int = 9) -> DataFrame:
    """MAT-16: reference-profile typing by Spearman correlation.

    ``expr(cell, gene, value)`` sparse (absent = 0); ``ref(ref_id, label, gene,
    value)`` dense over the marker genes G (the genes of ``ref``; at most ``MAX_MODEL`` rows).  A cell is one sparse
    vector; its ranks include the implicit zeros in closed form (the absent genes share one average rank), and the
    rank products with all profiles are one matrix product per batch, so the shuffle is linear in the entries.
    Score per label = ``quantile`` of the correlations with that label's reference samples (undefined ones left
    out); the label with the top score wins (scores equal to ``tie_digits`` decimals are ties, broken by label name).
    Cells without any marker gene are left out.
    """
    from repflow.operators.spectral import _entries, _products

    got = _bounded(_avg_ranks(ref, "ref_id").select("ref_id", "label", "gene", "rank"), "the reference")
    genes, refs = sorted({r["gene"] for r in got}), sorted({(r["label"], r["ref_id"]) for r in got})
    labels = sorted({x[0] for x in refs})
    ranks = np.zeros((len(genes), len(refs)))
    at_gene, at_ref = {g: i for i, g in enumerate(genes)}, {x: i for i, x in enumerate(refs)}
    for r in got:
        ranks[at_gene[r["gene"]], at_ref[r["label"], r["ref_id"]]] = r["rank"]
    of = [np.array([i for i, x in enumerate(refs) if x[0] == lab]) for lab in labels]
    n_g, s_r, v_r = float(len(genes)), ranks.sum(0), (ranks ** 2).sum(0) - ranks.sum(0) ** 2 / max(len(genes), 1)
    shared = expr.sparkSession.sparkContext.broadcast(ranks)

    def to_label(batches):
        for x in batches:
            g, v, off = _entries(x)
            k = np.diff(off)
            row = np.repeat(np.arange(len(k)), k)
            order = np.lexsort((v, row))
            first = np.ones(len(v), bool)                   # of equal values of a cell
            first[1:] = (v[order][1:] != v[order][:-1]) | (row[order][1:] != row[order][:-1])
            start = np.flatnonzero(first)
            size = np.diff(np.append(start, len(v)))
            place = start - off[:-1][row[order][start]]
            rank = np.empty(len(v))
            rank[order] = np.repeat(place + (size + 1) / 2.0, size)
            zeros = n_g - k
            rank += np.where(v > 0, zeros[row], 0.0)          # zeros stand between negative and positive values
            z = np.bincount(row, v < 0, len(k)) + (zeros + 1) / 2.0
            s_x = np.bincount(row, rank, len(k)) + zeros * z
            v_x = np.bincount(row, rank * rank, len(k)) + zeros * z * z - s_x * s_x / n_g
            s_xy = _products(g, rank, off, shared.value) + z[:, None] * (s_r - _products(g, np.ones(len(g)), off, shared.value))
            with np.errstate(invalid="ignore", divide="ignore"):
                corr = (s_xy - np.outer(s_x, s_r) / n_g) / np.sqrt(np.maximum(v_x, 0)[:, None] * np.maximum(v_r, 0))
            corr[~np.isfinite(corr)] = np.nan
            score = np.full((len(k), len(labels)), np.nan)
            for i, at in enumerate(of):
                some = ~np.isnan(corr[:, at]).all(1)
                score[some, i] = np.nanquantile(corr[some][:, at], quantile, axis=1)
            best = np.where(np.isnan(score), -np.inf, np.round(score, tie_digits)).argmax(1)
            top = score[np.arange(len(k)), best]
            yield pa.record_batch([x.column("cell"), pa.array(np.array(labels, object)[best], pa.string()),
                                   pa.array(top, mask=np.isnan(top))], names=["cell", "label", "score"])

    cells = _vectors(expr.where(F.col("value") != 0), genes)
    return cells.mapInArrow(to_label, cells.select("cell").schema.add("label", "string").add("score", "double"))
