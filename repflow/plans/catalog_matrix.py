"""Registered queries: sparse expression-matrix layer (MAT-1..16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from repflow.operators import matrix as M
from repflow.plans import fixtures as fx
from repflow.plans.oracle import CTES, with_ctes
from repflow.plans.partitioning import materialize
from repflow.plans.registry import r6, register

# fixture parameters (FIXTURES.md: min_genes=30, min_cells=3 for the derived matrix)
MIN_GENES, MIN_CELLS = 30, 3
TYPES = (("B cells", -1.0), ("CD4 T cells", -0.5), ("Monocytes", 0.0))

CTES.update({
    "mf1": (("expr",), f"""SELECT * FROM expr WHERE cell IN (
              SELECT cell FROM expr GROUP BY cell HAVING count(*) FILTER (WHERE value > 0) >= {MIN_GENES})"""),
    "mf2": (("mf1",), f"""SELECT * FROM mf1 WHERE gene IN (
              SELECT gene FROM mf1 GROUP BY gene HAVING count(*) FILTER (WHERE value > 0) >= {MIN_CELLS})"""),
    "mf3": (("mf2",), """SELECT * FROM mf2 WHERE cell IN (
              SELECT cell FROM mf2 GROUP BY cell
              HAVING sum(CASE WHEN gene LIKE 'MT-%' THEN value ELSE 0 END) * 100.0 / sum(value) < 20)"""),
    "logn": (("mf3",), """SELECT cell, gene, ln(1 + value * 10000 / sum(value) OVER (PARTITION BY cell)) AS value
              FROM mf3"""),
    "hvg": (("logn",), """
        SELECT gene, means, dispersions, mean_bin,
               (dispersions - CASE WHEN bsd IS NULL THEN 0 ELSE bm END) / (CASE WHEN bsd IS NULL THEN bm ELSE bsd END)
                 AS dispersions_norm
        FROM (SELECT gb.*, bs.bm, bs.bsd FROM (
                SELECT gd.*, CAST(CASE WHEN (hi - lo) / 20 > 0 THEN greatest(ceil((means - lo) / ((hi - lo) / 20)) - 1, 0)
                                       ELSE 0 END AS INTEGER) AS mean_bin
                FROM (SELECT gene, ln(1 + m) AS means, CASE WHEN var / m = 0 THEN NULL ELSE ln(var / m) END AS dispersions
                      FROM (SELECT gene, CASE WHEN s1 / n = 0 THEN 1e-12 ELSE s1 / n END AS m,
                                   (s2 - n * (s1 / n) * (s1 / n)) / (n - 1) AS var
                            FROM (SELECT gene, sum(exp(value) - 1) AS s1, sum((exp(value) - 1) * (exp(value) - 1)) AS s2
                                  FROM logn GROUP BY gene) g,
                                 (SELECT CAST(count(DISTINCT cell) AS DOUBLE) AS n FROM logn) nn)) gd,
                     (SELECT min(ln(1 + CASE WHEN s1 / n = 0 THEN 1e-12 ELSE s1 / n END)) AS lo,
                             max(ln(1 + CASE WHEN s1 / n = 0 THEN 1e-12 ELSE s1 / n END)) AS hi
                      FROM (SELECT gene, sum(exp(value) - 1) AS s1 FROM logn GROUP BY gene) g2,
                           (SELECT CAST(count(DISTINCT cell) AS DOUBLE) AS n FROM logn) nn2) rng) gb
              LEFT JOIN (SELECT mean_bin, avg(dispersions) AS bm, stddev_samp(dispersions) AS bsd FROM (
                  SELECT CAST(CASE WHEN (hi - lo) / 20 > 0 THEN greatest(ceil((means - lo) / ((hi - lo) / 20)) - 1, 0)
                                   ELSE 0 END AS INTEGER) AS mean_bin, dispersions
                  FROM (SELECT ln(1 + m) AS means, CASE WHEN var / m = 0 THEN NULL ELSE ln(var / m) END AS dispersions
                        FROM (SELECT CASE WHEN s1 / n = 0 THEN 1e-12 ELSE s1 / n END AS m,
                                     (s2 - n * (s1 / n) * (s1 / n)) / (n - 1) AS var
                              FROM (SELECT gene, sum(exp(value) - 1) AS s1, sum((exp(value) - 1) * (exp(value) - 1)) AS s2
                                    FROM logn GROUP BY gene) g, (SELECT CAST(count(DISTINCT cell) AS DOUBLE) AS n FROM logn) nn)) x,
                       (SELECT min(ln(1 + CASE WHEN s1 / n = 0 THEN 1e-12 ELSE s1 / n END)) AS lo,
                               max(ln(1 + CASE WHEN s1 / n = 0 THEN 1e-12 ELSE s1 / n END)) AS hi
                        FROM (SELECT gene, sum(exp(value) - 1) AS s1 FROM logn GROUP BY gene) g2,
                             (SELECT CAST(count(DISTINCT cell) AS DOUBLE) AS n FROM logn) nn2) r2)
                GROUP BY 1) bs ON bs.mean_bin = gb.mean_bin)"""),
})


def _logn(spark, sf):
    coo = M.preprocess(fx.expression(spark, sf), MIN_GENES, MIN_CELLS)
    # one materialised matrix feeds every later branch (HVG, scaling, typing)
    return materialize(M.log1p(M.normalise_total(coo)))


@register("cell_qc", "MAT-3 SCL-10", with_ctes("""
    SELECT cell, count(*) FILTER (WHERE value > 0) AS n_genes_by_counts, round(sum(value), 6) AS total_counts,
           round(sum(CASE WHEN gene LIKE 'MT-%' THEN value ELSE 0 END), 6) AS total_counts_mt,
           round(sum(CASE WHEN gene LIKE 'MT-%' THEN value ELSE 0 END) * 100.0 / sum(value), 6) AS pct_counts_mt
    FROM expr GROUP BY cell""", "expr"))
def q_cell_qc(spark, sf):
    q = M.cell_qc(fx.expression(spark, sf))
    return q.select("cell", "n_genes_by_counts", *[r6(c).alias(c) for c in ("total_counts", "total_counts_mt", "pct_counts_mt")])


@register("gene_qc", "MAT-3", with_ctes("""
    SELECT gene, count(*) FILTER (WHERE value > 0) AS n_cells_by_counts,
           round(sum(value) / (SELECT count(DISTINCT cell) FROM expr), 6) AS mean_counts,
           round(sum(value), 6) AS total_counts
    FROM expr GROUP BY gene""", "expr"))
def q_gene_qc(spark, sf):
    q = M.gene_qc(fx.expression(spark, sf))
    return q.select("gene", "n_cells_by_counts", r6("mean_counts").alias("mean_counts"), r6("total_counts").alias("total_counts"))


@register("filter_cells_genes", "MAT-1 MAT-2 MAT-4", with_ctes("""
    SELECT count(DISTINCT cell) AS n_cells, count(DISTINCT gene) AS n_genes, count(*) AS n_entries,
           round(sum(value), 6) AS total FROM mf3""", "mf3"))
def q_filter(spark, sf):
    c = M.preprocess(fx.expression(spark, sf), MIN_GENES, MIN_CELLS)
    return c.agg(F.count_distinct("cell").alias("n_cells"), F.count_distinct("gene").alias("n_genes"),
                 F.count(F.lit(1)).alias("n_entries"), r6(F.sum("value")).alias("total"))


@register("normalise_log1p", "MAT-5 MAT-6 SCL-2", with_ctes(
    "SELECT cell, gene, round(value, 6) AS value FROM logn", "logn"))
def q_norm(spark, sf):
    return _logn(spark, sf).select("cell", "gene", r6("value").alias("value"))


@register("highly_variable_genes", "MAT-7", with_ctes("""
    SELECT gene, round(means, 6) AS means, round(dispersions, 6) AS dispersions, mean_bin,
           round(dispersions_norm, 6) AS dispersions_norm,
           coalesce(means > 0.0125 AND means < 3 AND dispersions_norm > 0.5, false) AS highly_variable
    FROM hvg""", "hvg"))
def q_hvg(spark, sf):
    h = M.highly_variable_genes(_logn(spark, sf))
    return h.select("gene", r6("means").alias("means"), r6("dispersions").alias("dispersions"), "mean_bin",
                    r6("dispersions_norm").alias("dispersions_norm"), "highly_variable")


def _scale_ctes(gene_filter: str) -> dict:
    return {
        "sub": f"SELECT * FROM logn WHERE {gene_filter}",
        "ncell": "SELECT CAST(count(DISTINCT cell) AS DOUBLE) AS n FROM logn",
        "gs": """SELECT gene, s1 / n AS mean,
                       CASE WHEN sqrt(greatest((s2 - n * (s1 / n) * (s1 / n)) / (n - 1), 0)) = 0 THEN 1
                            ELSE sqrt(greatest((s2 - n * (s1 / n) * (s1 / n)) / (n - 1), 0)) END AS sd
                FROM (SELECT gene, sum(value) AS s1, sum(value * value) AS s2 FROM sub GROUP BY gene), ncell""",
        "scaled": """SELECT s.cell, s.gene, round(greatest(least((s.value - g.mean) / g.sd, 10), -10), 6) AS value
                     FROM sub s JOIN gs g ON g.gene = s.gene
                     UNION ALL
                     SELECT NULL, gene, round(greatest(least(-mean / sd, 10), -10), 6) FROM gs"""}


_HV_FILTER = """gene IN (SELECT gene FROM hvg
                WHERE coalesce(means > 0.0125 AND means < 3 AND dispersions_norm > 0.5, false))"""


def _scaled_out(entries, zeros):
    return entries.select("cell", "gene", r6("value").alias("value")).unionByName(
        zeros.select(F.lit(None).cast("string").alias("cell"), "gene", r6("value").alias("value")))


@register("scale_genes", "MAT-10", with_ctes("SELECT * FROM scaled", "logn", extra=_scale_ctes("true")))
def q_scale_all(spark, sf):
    logn = _logn(spark, sf)
    return _scaled_out(*M.scale(logn, cells=logn))


@register("scale_hvg", "MAT-8 MAT-9 MAT-10", with_ctes("SELECT * FROM scaled", "hvg", extra=_scale_ctes(_HV_FILTER)))
def q_scale(spark, sf):
    logn = _logn(spark, sf)                       # MAT-8: the normalised matrix stays available as is
    hv = M.highly_variable_genes(logn).where("highly_variable")
    entries, zeros = M.scale(M.subset_genes(logn, hv), cells=logn)
    return _scaled_out(entries, zeros)


def _weights(spark, sf):
    genes = _logn(spark, sf).select("gene").distinct()
    g = F.regexp_extract("gene", r"(\d+)", 1).cast("int")
    grp = fx.gene_group(F.col("gene"))
    items = [F.struct(F.lit(t).alias("cell_type"),
                      (F.when(grp == t, F.lit(0.01)).otherwise(F.lit(-0.005)) * (1 + g % 3)).alias("weight"))
             for t, _ in TYPES]
    return genes.select("gene", F.inline(F.array(*items)))


_WEIGHTS_SQL = """
    SELECT gene, t.cell_type, CASE WHEN (CASE WHEN g < 100 THEN 'CD4 T cells' WHEN g < 200 THEN 'B cells'
                                            WHEN g < 300 THEN 'Monocytes' END) = t.cell_type
                                   THEN 0.01 ELSE -0.005 END * (1 + g % 3) AS weight
    FROM (SELECT DISTINCT gene, CAST(regexp_extract(gene, '(\\d+)', 1) AS INTEGER) AS g FROM logn)
    JOIN (VALUES ('B cells', -1.0), ('CD4 T cells', -0.5), ('Monocytes', 0.0)) t(cell_type, intercept) ON true"""
_TYPED_SQL = f"""
    SELECT cell, cell_type AS predicted_labels, prob FROM (
      SELECT cell, cell_type, prob, row_number() OVER (PARTITION BY cell ORDER BY round(prob, 9) DESC, cell_type) AS rn FROM (
        SELECT l.cell, w.cell_type,
               1.0 / (1.0 + exp(-(sum(l.value * w.weight) + any_value(i.intercept)))) AS prob
        FROM logn l JOIN ({_WEIGHTS_SQL}) w ON w.gene = l.gene
        JOIN (VALUES ('B cells', -1.0), ('CD4 T cells', -0.5), ('Monocytes', 0.0)) i(cell_type, intercept)
          ON i.cell_type = w.cell_type
        GROUP BY 1, 2))
    WHERE rn = 1"""


def _typed(spark, sf):
    intercepts = spark.createDataFrame(list(TYPES), "cell_type string, intercept double")
    return M.type_scores(_logn(spark, sf), _weights(spark, sf), intercepts)


@register("cell_type_scores", "MAT-14", with_ctes(
    f"SELECT cell, predicted_labels, round(prob, 6) AS prob FROM ({_TYPED_SQL})", "logn"))
def q_typed(spark, sf):
    return _typed(spark, sf).select("cell", "predicted_labels", r6("prob").alias("prob"))


@register("majority_vote", "MAT-15", with_ctes(f"""
    SELECT t.cell, CAST(substring(t.cell, 5) AS INTEGER) % 12 AS cluster, t.predicted_labels, m.majority_voting
    FROM ({_TYPED_SQL}) t JOIN (
      SELECT cluster, predicted_labels AS majority_voting FROM (
        SELECT cluster, predicted_labels, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, predicted_labels) AS rn
        FROM (SELECT CAST(substring(cell, 5) AS INTEGER) % 12 AS cluster, predicted_labels FROM ({_TYPED_SQL}))
        GROUP BY 1, 2) WHERE rn = 1) m ON m.cluster = CAST(substring(t.cell, 5) AS INTEGER) % 12""", "logn"))
def q_majority(spark, sf):
    typed = _typed(spark, sf)
    clusters = typed.select("cell", (F.substring("cell", 5, 20).cast("int") % 12).alias("cluster"))
    return M.majority_vote(typed.select("cell", "predicted_labels"), clusters)


# reference profiles: 6 pseudo-bulk samples over all genes
REF_LABELS = ("B cells", "CD4 T cells", "Monocytes")


def _ref(spark, sf):
    e = fx.expression(spark, sf)
    rid = (F.substring("cell", 5, 20).cast("int") % 6)
    lab = F.when(rid % 3 == 0, REF_LABELS[0]).when(rid % 3 == 1, REF_LABELS[1]).otherwise(REF_LABELS[2])
    return e.groupBy(rid.alias("ref_id"), lab.alias("label"), "gene").agg(F.log1p(F.sum("value")).alias("value"))


_REF_SQL = """SELECT CAST(substring(cell, 5) AS INTEGER) % 6 AS ref_id,
                     CASE (CAST(substring(cell, 5) AS INTEGER) % 6) % 3 WHEN 0 THEN 'B cells' WHEN 1 THEN 'CD4 T cells'
                          ELSE 'Monocytes' END AS label, gene, ln(1 + sum(value)) AS value
              FROM expr GROUP BY 1, 2, 3"""


@register("spearman_typing", "MAT-16", with_ctes("""
    SELECT cell, label, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY cell ORDER BY round(score, 9) DESC, label) AS rn FROM sc) WHERE rn = 1""",
    "logn", "expr", extra={
        "ref": _REF_SQL,
        "markers": "SELECT DISTINCT gene FROM ref",
        "cells": "SELECT DISTINCT cell FROM logn WHERE gene IN (SELECT gene FROM markers) AND value <> 0",
        "dense": """SELECT c.cell, m.gene, coalesce(l.value, 0) AS value
                    FROM cells c JOIN markers m ON true LEFT JOIN logn l ON l.cell = c.cell AND l.gene = m.gene""",
        "rc": """SELECT cell, gene, rank() OVER (PARTITION BY cell ORDER BY value)
                        + (count(*) OVER (PARTITION BY cell, value) - 1) / 2.0 AS r FROM dense""",
        "rr": """SELECT ref_id, label, gene, rank() OVER (PARTITION BY ref_id ORDER BY value)
                        + (count(*) OVER (PARTITION BY ref_id, value) - 1) / 2.0 AS r FROM ref""",
        "cor": """SELECT rc.cell, rr.ref_id, rr.label, corr(rc.r, rr.r) AS c FROM rc JOIN rr ON rr.gene = rc.gene
                  GROUP BY 1, 2, 3""",
        "sc": "SELECT cell, label, quantile_cont(c, 0.8) AS score FROM cor GROUP BY 1, 2"}))
def q_spearman(spark, sf):
    t = M.spearman_typing(_logn(spark, sf), _ref(spark, sf))
    return t.select("cell", "label", r6("score").alias("score"))


_SPEARMAN_SQL = """SELECT cell, label, score FROM (
      SELECT *, row_number() OVER (PARTITION BY cell ORDER BY round(score, 9) DESC, label) AS rn FROM sc) WHERE rn = 1"""


@register("reference_annotation_join", "JN-10 JN-11", with_ctes("""
    SELECT q.cell, q.n_genes, a.label AS reference_label, round(c.x, 6) AS x, round(c.y, 6) AS y
    FROM (SELECT cell, count(*) AS n_genes FROM logn GROUP BY cell) q
    LEFT JOIN (SELECT cell, label FROM (
                 SELECT *, row_number() OVER (PARTITION BY cell ORDER BY round(score, 9) DESC, label) AS rn FROM sc)
               WHERE rn = 1) a ON a.cell = q.cell
    JOIN (SELECT cell, ln(1 + sum(value)) AS x, ln(1 + count(*)) AS y FROM logn GROUP BY cell) c ON c.cell = q.cell""",
    "logn", "expr", extra={
        "ref": _REF_SQL,
        "markers": "SELECT DISTINCT gene FROM ref",
        "cells": "SELECT DISTINCT cell FROM logn WHERE gene IN (SELECT gene FROM markers) AND value <> 0",
        "dense": """SELECT c.cell, m.gene, coalesce(l.value, 0) AS value
                    FROM cells c JOIN markers m ON true LEFT JOIN logn l ON l.cell = c.cell AND l.gene = m.gene""",
        "rc": """SELECT cell, gene, rank() OVER (PARTITION BY cell ORDER BY value)
                        + (count(*) OVER (PARTITION BY cell, value) - 1) / 2.0 AS r FROM dense""",
        "rr": """SELECT ref_id, label, gene, rank() OVER (PARTITION BY ref_id ORDER BY value)
                        + (count(*) OVER (PARTITION BY ref_id, value) - 1) / 2.0 AS r FROM ref""",
        "cor": """SELECT rc.cell, rr.ref_id, rr.label, corr(rc.r, rr.r) AS c FROM rc JOIN rr ON rr.gene = rc.gene
                  GROUP BY 1, 2, 3""",
        "sc": "SELECT cell, label, quantile_cont(c, 0.8) AS score FROM cor GROUP BY 1, 2"}))
def q_ref_join(spark, sf):
    """JN-10: per-cell table left-joined to the reference-based labels; JN-11: inner join
    with 2-D per-cell coordinates (here log totals, standing in for a layout)."""
    logn = _logn(spark, sf)
    cells = logn.groupBy("cell").agg(F.count(F.lit(1)).alias("n_genes"))
    labels = M.spearman_typing(logn, _ref(spark, sf)).select("cell", F.col("label").alias("reference_label"))
    coords = logn.groupBy("cell").agg(F.log1p(F.sum("value")).alias("x"), F.log1p(F.count(F.lit(1))).alias("y"))
    j = cells.join(labels, "cell", "left").join(coords, "cell", "inner")
    return j.select("cell", "n_genes", "reference_label", r6("x").alias("x"), r6("y").alias("y"))
