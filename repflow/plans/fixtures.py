"""Derived fixtures: domain inputs built by Spark from the driver tables.

The reference ships no inputs, so each domain table (reads, patterns, match
tables, cohort metadata, expression, contigs, annotations) is derived from
the TPC-H-like driver tables by a fixed rule.  Every derivation here has a
DuckDB twin in :mod:`repflow.plans.oracle` so each query can be checked
against an independent engine.  All derivations are lazy DataFrames whose
work grows with the base tables.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values for the fixture derivations ------------------------------
READ_LENGTH = 90
LETTERS = "abcdefghijklmnopqrstuvwxyz"
LETTER_TO_BASE = "ACGTACGTACGTACGTACGTACGTAC"
DIGIT_TO_AA = ("0123456789", "ASRLGQYEFW")
PATTERN_MIN_LEN = 6
# ---------------------------------------------------------------------------

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dna(text: Column) -> Column:
    """Letters of a text mapped onto ACGT (non-letters dropped)."""
    return F.translate(F.regexp_replace(F.lower(text), "[^a-z]", ""), LETTERS, LETTER_TO_BASE)


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``read_id, sequence, count, UMI, CB`` - documents cut in 90-base pieces."""
    from repflow.plans.partitioning import spread

    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    docs = docs.select("doc_id", dna(F.col("text")).alias("dna"))
    # pieces come from one regex pass; the document string is not copied per piece
    pieces = F.regexp_extract_all(F.col("dna"), F.lit(f"[A-Z]{{1,{READ_LENGTH}}}"), F.lit(0))
    r = docs.select("doc_id", F.posexplode(pieces).alias("piece", "sequence"))
    return r.select(
        F.concat(F.col("doc_id").cast("string"), F.lit("_"), F.col("piece").cast("string")).alias("read_id"),
        "sequence",
        (F.col("piece") % 5 + 1).cast("bigint").alias("count"),
        F.concat(F.lit("U"), (F.col("piece") % 50).cast("string")).alias("UMI"),
        F.concat(F.lit("Z:BC"), (F.col("doc_id") % 400).cast("string"), F.lit("-1")).alias("CB"),
    )


def patterns(spark: SparkSession, sf_dir: str, col_name: str = "CDR3.aa") -> DataFrame:
    """Pattern DB: windows of the +0 protein of each benchmark passage."""
    from repflow.functions.codon import six_frames_arrow_udf

    # passages are long: the vectorised kernel is linear in length (the
    # per-codon expression path is quadratic on long strings)
    udf, names = six_frames_arrow_udf()
    p = table(spark, sf_dir, "benchmark").select(udf(dna(F.col("text")))[names[0]].alias("p"))
    n = F.length("p")
    pos = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    w = p.select("p", F.explode(pos).alias("i")).select(
        F.expr("substring(p, i, 6 + i % 8)").alias("aa"))
    w = w.where((F.length("aa") >= PATTERN_MIN_LEN) & ~F.col("aa").contains("*")).distinct()
    return w.select(F.col("aa").alias(col_name))


def _digits_to_aa(c: Column) -> Column:
    return F.translate(c.cast("string"), *DIGIT_TO_AA)


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long match table ``sample, CDR3_match, count`` (100 samples)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("SRR"), (F.lit(1000) + F.col("l_suppkey")).cast("string")).alias("sample"),
        F.concat(F.when(F.col("l_partkey") % 4 == 0, "A").otherwise("C"),
                 _digits_to_aa(F.col("l_partkey") % 500),
                 F.repeat(F.lit("G"), (F.col("l_partkey") % 35).cast("int"))).alias("CDR3_match"),
        F.col("l_quantity").cast("bigint").alias("count"),
    )


def tissue_of(suppkey: Column) -> Column:
    return F.when(suppkey % 2 == 0, "Biopsy").otherwise("Blood")


def matches_with_tissue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match table plus ``Tissue`` of the sample (even supplier key: Biopsy)."""
    li = table(spark, sf_dir, "lineitem")
    m = matches(spark, sf_dir)
    return m.withColumn("Tissue", tissue_of(F.substring("sample", 4, 20).cast("bigint") - 1000))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort metadata ``ord, Run, patient_id, Disease, target`` with null keys."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("ord"),
        F.concat(F.lit("SRR"), (F.lit(1000) + k).cast("string")).alias("Run"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise((k % 60).cast("string")).alias("patient_id"),
        F.when(k % 5 == 0, "UC active").when(k % 5 == 1, "cd").when(k % 5 == 2, "CONTROL")
         .when(k % 5 == 3, F.lit(None).cast("string")).otherwise("other").alias("Disease"),
        F.when(F.col("s_acctbal") > 5000, "active").otherwise("inactive").alias("target"),
    )


def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse expression matrix in coordinate form ``cell, gene, value``."""
    li = table(spark, sf_dir, "lineitem")
    g = F.col("l_partkey") % 300
    return li.groupBy(
        F.concat(F.lit("CELL"), (F.col("l_orderkey") % 1500).cast("string")).alias("cell"),
        F.concat(F.when(g < 15, "MT-").otherwise("G"), g.cast("string")).alias("gene"),
    ).agg(F.sum("l_quantity").cast("double").alias("value"))


def expression_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse expression matrix of 600 cells and up to 2,000 genes, with variable genes (MAT-7 selects some)."""
    li = table(spark, sf_dir, "lineitem")
    g = F.col("l_partkey") % 2000
    return li.groupBy(
        F.concat(F.lit("CELL"), (F.col("l_orderkey") % 600).cast("string")).alias("cell"),
        F.concat(F.when(g < 20, "MT-").otherwise("G"), g.cast("string")).alias("gene"),
    ).agg(F.sum("l_quantity").cast("double").alias("value"))


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VDJ contigs ``sample, barcode, cdr3``."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_linenumber") == 1)
    return li.select(
        F.concat(F.lit("SRX"), (F.lit(1000) + F.col("l_suppkey") % 16).cast("string"), F.lit("_vdj")).alias("sample"),
        F.concat(F.lit("BC"), (F.col("l_orderkey") % 400).cast("string"), F.lit("-1")).alias("barcode"),
        F.concat(F.lit("C"), _digits_to_aa(F.col("l_partkey") % 700),
                 F.repeat(F.lit("G"), (F.col("l_partkey") % 35).cast("int"))).alias("cdr3"),
    ).distinct()


def igblast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation table ``sequence_id, v_support, j_support, v_identity, j_identity``."""
    e = table(spark, sf_dir, "events")
    v = F.col("value")
    return e.select(
        F.col("event_id").cast("string").alias("sequence_id"),
        (v / 1e7).alias("v_support"), (v / 2e7).alias("j_support"),
        (F.lit(80) + v % 20).alias("v_identity"), (F.lit(80) + (v * 3) % 20).alias("j_identity"),
    )


def srx_dictionary(spark: SparkSession, assay: str) -> DataFrame:
    """Sample dictionary ``srx, patient, sample_type, ord`` (16 entries per assay).

    Assay A holds SRX1000..1015, assay B SRX2000..2015; patient ``P(i/2)``;
    the type alternates ``tumor`` / ``LNM``.  Size is fixed by the rule.
    """
    base = {"A": 1000, "B": 2000}[assay]
    rows = [(f"SRX{base + i}", f"P{i // 2}", "tumor" if i % 2 == 0 else "LNM", i) for i in range(16)]
    return spark.createDataFrame(rows, "srx string, patient string, sample_type string, ord int")


def _cdr3_rule(key: Column, mod: int = 700) -> Column:
    return F.concat(F.lit("C"), _digits_to_aa(key % mod), F.repeat(F.lit("G"), (key % 35).cast("int")))


def sc_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-cell match table ``seq_id, CDR3_match, UMI, CB`` (raw barcodes).

    Barcodes carry the ``Z:`` tag and a ``-1`` or ``*`` suffix; some are null.
    """
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    return li.select(
        ((F.col("l_orderkey") * 7 + ln) % 12000).cast("string").alias("seq_id"),
        _cdr3_rule(F.col("l_partkey") + F.col("l_suppkey")).alias("CDR3_match"),
        F.concat(F.lit("U"), ln.cast("string")).alias("UMI"),
        F.when(ln == 7, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("Z:BC"), (F.col("l_orderkey") % 400).cast("string"),
                     F.when(ln == 3, F.lit("*")).otherwise(F.lit("-1")))).alias("CB"),
    )


def publicness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publicness rows ``CDR3_match, publicness_score, ord`` with repeated sequences."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(_cdr3_rule(F.col("l_partkey")).alias("CDR3_match"),
                     (F.col("l_discount") * 10).alias("publicness_score"),
                     (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))


def expression_barcoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expression COO with 10x-style barcodes ``BC<k>-1`` for cell ``CELL<k>``."""
    e = expression(spark, sf_dir)
    return e.withColumn("barcode", F.concat(F.replace(F.col("cell"), F.lit("CELL"), F.lit("BC")), F.lit("-1")))


# fixed values: gene groups of the rule-based reference typing
CELL_TYPE_GROUPS = ((100, "CD4 T cells"), (200, "B cells"), (300, "Monocytes"))


def gene_group(gene: Column) -> Column:
    g = F.regexp_extract(gene, r"(\d+)", 1).cast("int")
    out = None
    for bound, label in CELL_TYPE_GROUPS:
        out = F.when(g < bound, label) if out is None else out.when(g < bound, label)
    return out


def cell_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell annotation ``Cell_Barcode, Annotation_Label``: gene group with the most counts."""
    from pyspark.sql import Window

    e = expression_barcoded(spark, sf_dir)
    s = e.groupBy("barcode", gene_group(F.col("gene")).alias("label")).agg(F.sum("value").alias("s"))
    w = Window.partitionBy("barcode").orderBy(F.desc("s"), F.asc("label"))
    return s.withColumn("rn", F.row_number().over(w)).where("rn = 1").select(
        F.col("barcode").alias("Cell_Barcode"), F.col("label").alias("Annotation_Label"))
