"""Registered queries: single-cell layer (cleaning, classifier table, overlap)."""

from __future__ import annotations

from pyspark.sql import functions as F

from repflow.functions import scalar as S
from repflow.operators import relational as R
from repflow.operators import repertoire as P
from repflow.operators import singlecell as SC
from repflow.plans import fixtures as fx
from repflow.plans.oracle import with_ctes
from repflow.plans.registry import r6, register

_UNIFIED = """
    SELECT i.sequence_id AS IgBlast_sequence_id, i.v_support AS IgBlast_v_support, i.j_support AS IgBlast_j_support,
           i.v_identity AS IgBlast_v_identity, i.j_identity AS IgBlast_j_identity,
           m.seq_id, m.CDR3_match, m.UMI, replace(replace(replace(m.CB, 'Z:', ''), '*', '-1'), '-1', '') AS CB
    FROM igblast i LEFT JOIN sc_matches m ON i.sequence_id = m.seq_id"""
_PUB1 = """SELECT CDR3_match, publicness_score FROM (
             SELECT *, row_number() OVER (PARTITION BY CDR3_match ORDER BY ord) AS rn FROM publicness) WHERE rn = 1"""
_EXPR_SUM = """SELECT replace(barcode, '-1', '') AS CB, count(*) FILTER (WHERE value > 0) AS n_genes,
                      sum(value) AS total_counts FROM expr_bc GROUP BY 1"""
_VDJ = """SELECT sample AS vdj_sample, regexp_replace(barcode, '-1$', '') AS vdj_barcode, cdr3 AS vdj_cdr3
          FROM contigs"""
_CLASSIFIER = f"""
    SELECT u.*, p.publicness_score, e.n_genes, e.total_counts, c.cell_type,
           coalesce(v.hit, false) AS is_in_vdj,
           coalesce(contains(lower(coalesce(c.cell_type, '')), 't cells'), false) AND coalesce(v.hit, false) AS label
    FROM ({_UNIFIED}) u
    LEFT JOIN ({_PUB1}) p ON u.CDR3_match = p.CDR3_match
    LEFT JOIN ({_EXPR_SUM}) e ON u.CB = e.CB
    LEFT JOIN (SELECT DISTINCT replace(Cell_Barcode, '-1', '') AS cb, Annotation_Label AS cell_type FROM cell_types) c
           ON u.CB = c.cb
    LEFT JOIN (SELECT DISTINCT vdj_cdr3, vdj_barcode, true AS hit FROM ({_VDJ})) v
           ON u.CDR3_match IS NOT DISTINCT FROM v.vdj_cdr3 AND u.CB IS NOT DISTINCT FROM v.vdj_barcode"""
_SC_CTES = ("igblast", "sc_matches", "publicness", "expr_bc", "cell_types", "contigs")


def _vdj(spark, sf):
    return SC.clean_vdj(fx.contigs(spark, sf))


def _classifier(spark, sf):
    unified = SC.annotate_matches(fx.igblast(spark, sf), fx.sc_matches(spark, sf))
    ct = fx.cell_types(spark, sf).withColumn("Cell_Barcode", S.clean_expression_barcode(F.col("Cell_Barcode")))
    return SC.classifier_table(unified, fx.publicness(spark, sf), fx.expression_barcoded(spark, sf), ct,
                               _vdj(spark, sf))


_ROUND = ("IgBlast_v_support", "IgBlast_j_support", "IgBlast_v_identity", "IgBlast_j_identity",
          "publicness_score", "total_counts")


@register("classifier_table", "JN-5 JN-6 JN-7 JN-8 JN-9 PRJ-3 SRC-9 SRC-13 DED-1 SCL-3 SCL-4 SCL-5", with_ctes(
    f"""SELECT IgBlast_sequence_id, round(IgBlast_v_support, 6) AS IgBlast_v_support,
               round(IgBlast_j_support, 6) AS IgBlast_j_support, round(IgBlast_v_identity, 6) AS IgBlast_v_identity,
               round(IgBlast_j_identity, 6) AS IgBlast_j_identity, seq_id, CDR3_match, UMI, CB,
               round(publicness_score, 6) AS publicness_score, n_genes, round(total_counts, 6) AS total_counts,
               cell_type, is_in_vdj, label FROM ({_CLASSIFIER})""", *_SC_CTES))
def q_classifier(spark, sf):
    t = _classifier(spark, sf)
    return t.select(*[r6(c).alias(c) if c in _ROUND else F.col(c) for c in t.columns])


@register("classifier_expression", "JN-7", with_ctes(f"""
    SELECT c.IgBlast_sequence_id, c.seq_id, c.UMI, c.CB, c.is_in_vdj, len(x.genes) AS n_values, x.genes[1] AS first_gene,
           round(list_sum(list_transform(range(1, len(x.genes) + 1), lambda i: i * x.vals[i])), 6) AS weighted
    FROM ({_CLASSIFIER}) c LEFT JOIN (
      SELECT CB, list(gene ORDER BY gene) AS genes, list(value ORDER BY gene) AS vals FROM (
        SELECT replace(barcode, '-1', '') AS CB, gene, sum(value) AS value FROM expr_bc GROUP BY 1, 2) GROUP BY CB) x ON x.CB = c.CB""",
    *_SC_CTES))
def q_classifier_expression(spark, sf):
    """The classifier table with one expression vector per cell; its size, first gene and place-weighted sum stand for it."""
    t = SC.with_expression(_classifier(spark, sf), fx.expression_barcoded(spark, sf))
    placed = F.aggregate(F.transform("values", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return t.select("IgBlast_sequence_id", "seq_id", "UMI", "CB", "is_in_vdj", F.when(F.col("genes").isNotNull(), F.size("genes")).cast("long").alias("n_values"),
                    F.get("genes", F.lit(0)).alias("first_gene"), r6(placed).alias("weighted"))


@register("repertoire_summary", "AGG-14 SET-1 AGG-12", with_ctes(f"""
    SELECT count(DISTINCT CDR3_match) AS n_cdr3_matches, count(DISTINCT CB) AS n_barcodes,
           count(*) FILTER (WHERE is_in_vdj) AS n_rows_in_vdj,
           count(DISTINCT CASE WHEN label THEN CDR3_match END) AS n_tcell_vdj_cdr3,
           (SELECT count(DISTINCT vdj_cdr3) FROM ({_VDJ})) AS n_cdr3_vdj,
           (SELECT count(*) FROM (SELECT DISTINCT CDR3_match FROM ({_CLASSIFIER}) WHERE CDR3_match IS NOT NULL
                                  INTERSECT SELECT DISTINCT vdj_cdr3 FROM ({_VDJ}))) AS n_shared
    FROM ({_CLASSIFIER})""", *_SC_CTES))
def q_summary(spark, sf):
    return SC.repertoire_summary(_classifier(spark, sf), _vdj(spark, sf))


@register("unique_cdr3_per_cell_type", "AGG-10 SRT-1", with_ctes(f"""
    SELECT cell_type, count(DISTINCT CDR3_match) AS n_unique_cdr3 FROM ({_CLASSIFIER})
    WHERE cell_type IS NOT NULL GROUP BY 1""", *_SC_CTES))
def q_per_cell_type(spark, sf):
    t = _classifier(spark, sf).where(F.col("cell_type").isNotNull())
    return R.unique_per_group(t, "cell_type", "CDR3_match", "n_unique_cdr3")


@register("label_counts", "AGG-11", with_ctes(f"""
    SELECT label, count(*) AS count FROM ({_CLASSIFIER}) GROUP BY 1""", *_SC_CTES))
def q_label_counts(spark, sf):
    return R.value_counts(_classifier(spark, sf), "label")


@register("classifier_null_counts", "AGG-13", with_ctes(f"""
    SELECT (SELECT count(*) FROM ({_CLASSIFIER})) AS n_rows, col AS "column", n_null FROM (
      SELECT 'CDR3_match' AS col, count(*) FILTER (WHERE CDR3_match IS NULL) AS n_null FROM ({_CLASSIFIER})
      UNION ALL SELECT 'CB', count(*) FILTER (WHERE CB IS NULL) FROM ({_CLASSIFIER})
      UNION ALL SELECT 'cell_type', count(*) FILTER (WHERE cell_type IS NULL) FROM ({_CLASSIFIER})
      UNION ALL SELECT 'publicness_score', count(*) FILTER (WHERE publicness_score IS NULL) FROM ({_CLASSIFIER}))""",
    *_SC_CTES))
def q_null_counts(spark, sf):
    return R.null_counts(_classifier(spark, sf), ["CDR3_match", "CB", "cell_type", "publicness_score"])


@register("classifier_preview", "LIM-1", with_ctes(f"""
    SELECT IgBlast_sequence_id, seq_id, CDR3_match, CB, cell_type, is_in_vdj FROM ({_CLASSIFIER})
    ORDER BY IgBlast_sequence_id, seq_id NULLS FIRST, CDR3_match NULLS FIRST, CB NULLS FIRST, UMI NULLS FIRST
    LIMIT 5""", *_SC_CTES))
def q_preview(spark, sf):
    t = _classifier(spark, sf)
    order = [F.col(c).asc_nulls_first() for c in ("IgBlast_sequence_id", "seq_id", "CDR3_match", "CB", "UMI")]
    return R.preview(t, order, 5).select("IgBlast_sequence_id", "seq_id", "CDR3_match", "CB", "cell_type",
                                         "is_in_vdj")


@register("t_cell_filters", "FLT-3 FLT-4", with_ctes("""
    SELECT count(*) FILTER (WHERE coalesce(contains(lower(Annotation_Label), 't cells'), false)) AS n_t_cells_ci,
           count(*) FILTER (WHERE coalesce(contains(Annotation_Label, 'T-cells'), false)) AS n_t_cells_hyphen,
           count(*) AS n_cells
    FROM cell_types""", "cell_types"))
def q_t_cells(spark, sf):
    ct = fx.cell_types(spark, sf)
    return ct.agg(F.count_if(S.contains_ci(F.col("Annotation_Label"), SC.T_CELL_TEXT)).alias("n_t_cells_ci"),
                  F.count_if(S.contains_cs(F.col("Annotation_Label"), SC.T_CELL_TEXT_HYPHEN)).alias("n_t_cells_hyphen"),
                  F.count(F.lit(1)).alias("n_cells"))


@register("barcode_clean", "SCL-3 SCL-4 SCL-5", with_ctes("""
    SELECT 'match' AS kind, CB AS raw, replace(replace(replace(CB, 'Z:', ''), '*', '-1'), '-1', '') AS clean
      FROM (SELECT DISTINCT CB FROM sc_matches)
    UNION ALL SELECT 'expression', barcode, replace(barcode, '-1', '') FROM (SELECT DISTINCT barcode FROM expr_bc)
    UNION ALL SELECT 'vdj', barcode, regexp_replace(barcode, '-1$', '') FROM (SELECT DISTINCT barcode FROM contigs)""",
    "sc_matches", "expr_bc", "contigs"))
def q_barcodes(spark, sf):
    m = fx.sc_matches(spark, sf).select("CB").distinct()
    e = fx.expression_barcoded(spark, sf).select("barcode").distinct()
    v = fx.contigs(spark, sf).select("barcode").distinct()
    return (m.select(F.lit("match").alias("kind"), F.col("CB").alias("raw"), S.clean_match_barcode(F.col("CB")).alias("clean"))
            .unionByName(e.select(F.lit("expression").alias("kind"), F.col("barcode").alias("raw"),
                                  S.clean_expression_barcode(F.col("barcode")).alias("clean")))
            .unionByName(v.select(F.lit("vdj").alias("kind"), F.col("barcode").alias("raw"),
                                  S.clean_vdj_barcode(F.col("barcode")).alias("clean"))))


@register("igblast_strict", "FLT-1", with_ctes(f"""
    SELECT IgBlast_sequence_id, seq_id, CDR3_match FROM ({_UNIFIED})
    WHERE IgBlast_v_support < 1e-5 AND IgBlast_v_identity >= 90 AND IgBlast_j_support < 1e-5
      AND IgBlast_j_identity >= 90""", "igblast", "sc_matches"))
def q_strict(spark, sf):
    u = SC.annotate_matches(fx.igblast(spark, sf), fx.sc_matches(spark, sf))
    return SC.strict_filter(u).select("IgBlast_sequence_id", "seq_id", "CDR3_match")


@register("barcode_probe", "FLT-8", with_ctes("""
    SELECT count(*) > 0 AS present FROM (SELECT 1 FROM sc_matches
      WHERE replace(replace(replace(CB, 'Z:', ''), '*', '-1'), '-1', '') = 'BC7' LIMIT 1)""", "sc_matches"))
def q_probe(spark, sf):
    m = SC.clean_match_table(fx.sc_matches(spark, sf))
    return R.key_present(m, "CB", "BC7")


_SET_B = """SELECT 'SRX' || CAST(2000 + (CAST(substring(sample, 4) AS INTEGER) - 1000) % 16 AS VARCHAR) AS srx,
                   CDR3_match AS cdr3 FROM matches"""
_SET_A = """SELECT nullif(regexp_extract(replace(sample, '_vdj', ''), '(SRX\\d+)', 1), '') AS srx, cdr3 FROM contigs"""


def _set_b(spark, sf):
    m = fx.matches(spark, sf)
    k = (F.substring("sample", 4, 20).cast("int") - 1000) % 16
    return m.select(F.concat(F.lit("SRX"), (F.lit(2000) + k).cast("string")).alias("srx"), F.col("CDR3_match").alias("cdr3"))


def _set_a(spark, sf):
    c = fx.contigs(spark, sf)
    return c.select(S.extract_srx(F.col("sample")).alias("srx"), "cdr3")


@register("srx_extract", "SCL-6 SRC-8", with_ctes(
    "SELECT DISTINCT sample, nullif(regexp_extract(replace(sample, '_vdj', ''), '(SRX\\d+)', 1), '') AS srx FROM contigs",
    "contigs"))
def q_srx(spark, sf):
    c = fx.contigs(spark, sf).select("sample").distinct()
    return c.select("sample", S.extract_srx(F.col("sample")).alias("srx"))


@register("vdj_sets", "SET-3 DED-2", with_ctes(
    f"SELECT srx, count(DISTINCT cdr3) AS n_cdr3 FROM ({_SET_A}) GROUP BY 1", "contigs"))
def q_vdj_sets(spark, sf):
    a = _set_a(spark, sf).distinct()
    return a.groupBy("srx").agg(F.count("cdr3").alias("n_cdr3"))


_PAIRS = """SELECT srx_a, srx_b, patient, sample_type FROM (
      SELECT a.srx AS srx_a, b.srx AS srx_b, a.patient, a.sample_type,
             row_number() OVER (PARTITION BY a.srx ORDER BY b.ord NULLS LAST) AS rn
      FROM dict_a a LEFT JOIN dict_b b ON a.patient = b.patient AND lower(a.sample_type) = lower(b.sample_type))
    WHERE rn = 1"""


@register("assay_overlap", "SET-4 JN-12 SET-1 SRC-14", with_ctes(f"""
    SELECT p.srx_a, p.srx_b, p.patient, p.sample_type,
           CAST(coalesce(na.n, 0) AS BIGINT) AS n_a, CAST(coalesce(nb.n, 0) AS BIGINT) AS n_b,
           CAST(coalesce(ns.n, 0) AS BIGINT) AS n_shared
    FROM ({_PAIRS}) p
    LEFT JOIN (SELECT srx, count(DISTINCT cdr3) AS n FROM ({_SET_A}) GROUP BY 1) na ON na.srx = p.srx_a
    LEFT JOIN (SELECT srx, count(DISTINCT cdr3) AS n FROM ({_SET_B}) GROUP BY 1) nb ON nb.srx = p.srx_b
    LEFT JOIN (SELECT p2.srx_a, count(*) AS n FROM ({_PAIRS}) p2
               JOIN (SELECT DISTINCT srx, cdr3 FROM ({_SET_A})) a ON a.srx = p2.srx_a
               JOIN (SELECT DISTINCT srx, cdr3 FROM ({_SET_B})) b ON b.srx = p2.srx_b AND b.cdr3 = a.cdr3
               GROUP BY 1) ns ON ns.srx_a = p.srx_a""", "contigs", "matches", "dict_a", "dict_b"))
def q_overlap(spark, sf):
    pairs = P.pair_samples(fx.srx_dictionary(spark, "A"), fx.srx_dictionary(spark, "B"))
    return P.overlap_report(_set_a(spark, sf), _set_b(spark, sf), pairs)


@register("sc_richness_summary", "AGG-15 AGG-1 SCL-1 SET-2", with_ctes(f"""
    SELECT b.srx AS sample, count(DISTINCT b.cdr3) AS Unique_CDR3_Count, d.sample_type AS Tissue,
           round(log10(count(DISTINCT b.cdr3) + 1), 6) AS Log_Value
    FROM ({_SET_B}) b JOIN dict_b d ON d.srx = b.srx GROUP BY b.srx, d.sample_type""", "matches", "dict_b"))
def q_sc_richness(spark, sf):
    b = _set_b(spark, sf).join(F.broadcast(fx.srx_dictionary(spark, "B")), "srx")
    parts = []
    for t in ("tumor", "LNM"):
        part = b.where(F.col("sample_type") == t).select(F.col("srx").alias("sample"), "cdr3", F.col("sample_type").alias("Tissue"))
        parts.append(P.richness_summary(part, "Tissue", "sample", "cdr3"))
    u = parts[0].unionByName(parts[1])
    return u.select("sample", "Unique_CDR3_Count", "Tissue", r6("Log_Value").alias("Log_Value"))


@register("sample_key_hash", "SCL-12", with_ctes(
    "SELECT sample, substring(sha1(sample), 1, 12) AS key FROM (SELECT DISTINCT sample FROM matches)", "matches"))
def q_hash(spark, sf):
    return fx.matches(spark, sf).select("sample").distinct().select("sample", S.sha1_12(F.col("sample")).alias("key"))


@register("classifier_features", "PRJ-2")
def q_features(spark, sf):
    """Numeric feature columns by schema minus the exclusion list, assembled into one vector."""
    from pyspark.ml.feature import VectorAssembler

    t = _classifier(spark, sf)
    return VectorAssembler(inputCols=SC.feature_columns(t, "v1"), outputCol="features", handleInvalid="keep").transform(t) \
        .select("IgBlast_sequence_id", "features", "label")
