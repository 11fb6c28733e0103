"""Single-cell repertoire operators: cleaned inputs, classifier table, summaries.

The classifier table is a chain of left joins onto the annotation rows.  Each
dimension side (publicness, per-cell expression summary, cell types, VDJ key
set) is reduced to one row per key *before* its join, so no join fans out
beyond the reference's own 1:N annotation join, and a hot key on a dimension
side cannot multiply rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repflow.functions import scalar as S
from repflow.operators import relational as R
from repflow.schema import validate_columns

# --- fixed values (strict annotation filter thresholds) ---------------------
STRICT_MAX_SUPPORT = 1e-5
STRICT_MIN_IDENTITY = 90.0
T_CELL_TEXT = "T cells"
T_CELL_TEXT_HYPHEN = "T-cells"
# ---------------------------------------------------------------------------


def clean_match_table(sc_matches: DataFrame, cb: str = "CB") -> DataFrame:
    """SCL-3 applied to a single-cell match table."""
    return sc_matches.withColumn(cb, S.clean_match_barcode(F.col(cb)))


def clean_vdj(contigs: DataFrame, prefix: str = "vdj_") -> DataFrame:
    """SRC-9 + SCL-5: prefix the contig columns, strip a trailing ``-1`` from barcodes."""
    v = R.prefix_columns(contigs, prefix)
    return v.withColumn(f"{prefix}barcode", S.clean_vdj_barcode(F.col(f"{prefix}barcode")))


def strict_filter(annot: DataFrame, prefix: str = "IgBlast_") -> DataFrame:
    """FLT-1: v/j support below 1e-5 and v/j identity at least 90 (null fails)."""
    c = lambda n: F.col(prefix + n)
    cond = ((c("v_support") < STRICT_MAX_SUPPORT) & (c("v_identity") >= STRICT_MIN_IDENTITY)
            & (c("j_support") < STRICT_MAX_SUPPORT) & (c("j_identity") >= STRICT_MIN_IDENTITY))
    return annot.where(F.coalesce(cond, F.lit(False)))


def annotate_matches(igblast: DataFrame, sc_matches: DataFrame, id_col: str = "seq_id") -> DataFrame:
    """SRC-9 + JN-5: prefixed annotation rows left-joined to cleaned match rows on the id."""
    a = R.prefix_columns(igblast, "IgBlast_")
    m = clean_match_table(sc_matches)
    return a.join(m, a["IgBlast_sequence_id"] == m[id_col], "left")


def first_publicness(pub: DataFrame, order_col: str = "ord") -> DataFrame:
    """SRC-13: first publicness row per sequence (explicit ordinal)."""
    return R.keep_first(pub, "CDR3_match", order_col).select("CDR3_match", "publicness_score")


def cell_expression_summary(expr: DataFrame, barcode: str = "barcode") -> DataFrame:
    """Per-cell expression summary keyed by cleaned barcode (SCL-4)."""
    e = expr.withColumn("CB", S.clean_expression_barcode(F.col(barcode)))
    return e.groupBy("CB").agg(F.count_if(F.col("value") > 0).alias("n_genes"),
                               F.sum("value").alias("total_counts"))


def expression_vectors(expr: DataFrame, barcode: str = "barcode") -> DataFrame:
    """JN-7: ``(CB, genes, values)``: one expression vector per cleaned barcode (SCL-4), genes in order.

    Entries of one barcode and gene are added up; null genes and values are left out.
    """
    e = expr.where("gene IS NOT NULL AND value IS NOT NULL").groupBy(
        S.clean_expression_barcode(F.col(barcode)).alias("CB"), "gene").agg(F.sum("value").alias("value"))
    x = e.groupBy("CB").agg(F.sort_array(F.collect_list(F.struct("gene", "value"))).alias("x"))
    return x.select("CB", F.transform("x", lambda v: v["gene"]).alias("genes"), F.transform("x", lambda v: v["value"]).alias("values"))


def with_expression(table: DataFrame, expr: DataFrame, barcode: str = "barcode") -> DataFrame:
    """JN-7: the classifier table with each row's cell's expression vector (null where the cell has none)."""
    return table.join(expression_vectors(expr, barcode), "CB", "left").select(*table.columns, "genes", "values")


def feature_columns(table: DataFrame, rule: str = "v2", exclude=("label", "is_in_vdj")) -> list[str]:
    """PRJ-2: the feature columns of a table: ``v1`` numeric types only, ``v2`` everything but strings, both without ``exclude``."""
    from pyspark.sql import types as T

    if rule not in ("v1", "v2"):
        raise ValueError("rule is v1 or v2")
    kept = (lambda t: isinstance(t, T.NumericType)) if rule == "v1" else (lambda t: not isinstance(t, (T.StringType, T.CharType, T.VarcharType)))
    return [f.name for f in table.schema.fields if f.name not in exclude and kept(f.dataType)]


def classifier_table(unified: DataFrame, publicness: DataFrame, expr: DataFrame,
                     cell_types: DataFrame | None, vdj: DataFrame) -> DataFrame:
    """JN-6, JN-7, JN-8, JN-9, PRJ-3: the classifier table.

    ``cell_types`` may be None (missing annotation -> null column, JN-8).
    ``vdj`` is the cleaned, prefixed contig table.
    """
    validate_columns(unified, ["CDR3_match", "CB"], "annotated matches")
    t = unified.join(first_publicness(publicness), "CDR3_match", "left")
    t = t.join(cell_expression_summary(expr), "CB", "left")
    if cell_types is not None:
        ct = cell_types.select(F.col("Cell_Barcode").alias("__cb"),
                               F.col("Annotation_Label").alias("cell_type")).distinct()
        ct = R.keep_first(ct, "__cb", "cell_type")
        t = t.join(ct, t["CB"] == ct["__cb"], "left").drop("__cb")
    else:
        t = t.withColumn("cell_type", F.lit(None).cast("string"))
    t = R.flag_membership(t, vdj, ["CDR3_match", "CB"], ["vdj_cdr3", "vdj_barcode"], flag="is_in_vdj")
    label = S.contains_ci(F.coalesce(F.col("cell_type"), F.lit("")), T_CELL_TEXT) & F.col("is_in_vdj")
    return t.withColumn("label", label)


def repertoire_summary(table: DataFrame, vdj: DataFrame) -> DataFrame:
    """AGG-14 + SET-1 + AGG-12: one row of distinct counts over the classifier table."""
    a = table.select(F.col("CDR3_match").alias("s")).where("s IS NOT NULL").distinct()
    b = vdj.select(F.col("vdj_cdr3").alias("s")).where("s IS NOT NULL").distinct()
    both = a.join(b, "s", "left_semi").agg(F.count(F.lit(1)).alias("n_shared"))
    t = table.agg(
        F.count_distinct("CDR3_match").alias("n_cdr3_matches"),
        F.count_distinct("CB").alias("n_barcodes"),
        F.count_if(F.col("is_in_vdj")).alias("n_rows_in_vdj"),
        F.count_distinct(F.when(F.col("label"), F.col("CDR3_match"))).alias("n_tcell_vdj_cdr3"))
    nb = b.agg(F.count(F.lit(1)).alias("n_cdr3_vdj"))
    return t.withColumn("__k", F.lit(1)).join(nb.withColumn("__k", F.lit(1)), "__k") \
        .join(both.withColumn("__k", F.lit(1)), "__k").drop("__k")
