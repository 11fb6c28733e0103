"""Registered queries: bulk cohort layer (richness, spectra, metadata joins, matrix)."""

from __future__ import annotations

from pyspark.sql import functions as F

from repflow.functions import scalar as S
from repflow.operators import relational as R
from repflow.operators import repertoire as P
from repflow.operators.quantiles import exact_quantiles
from repflow.plans import fixtures as fx
from repflow.plans.oracle import with_ctes
from repflow.plans.partitioning import materialize
from repflow.plans.registry import r6, register

RICH_SQL = """SELECT sample, count(DISTINCT CDR3_match) AS Unique_CDR3_Count, any_value(Tissue) AS Tissue
              FROM matches GROUP BY sample"""


def _rich(spark, sf):
    return P.richness_summary(fx.matches_with_tissue(spark, sf))


@register("richness", "AGG-1", with_ctes(
    "SELECT sample, count(DISTINCT CDR3_match) AS Unique_CDR3_Count FROM matches GROUP BY sample", "matches"))
def q_richness(spark, sf):
    return P.richness(fx.matches(spark, sf))


@register("richness_summary", "AGG-15 SCL-1 SET-2 PRJ-1", with_ctes(f"""
    SELECT sample, Unique_CDR3_Count, Tissue, round(log10(Unique_CDR3_Count + 1), 6) AS Log_Value
    FROM ({RICH_SQL})""", "matches"))
def q_richness_summary(spark, sf):
    # union of per-tissue tables (SET-2) then the log transform
    m = fx.matches_with_tissue(spark, sf)
    parts = [P.richness_summary(m.where(F.col("Tissue") == t)) for t in ("Biopsy", "Blood")]
    u = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return u.select("sample", "Unique_CDR3_Count", "Tissue", r6("Log_Value").alias("Log_Value"))


@register("richness_median_by_tissue", "AGG-5", with_ctes(f"""
    SELECT Tissue, round(quantile_cont(Unique_CDR3_Count, 0.5), 6) AS median_count,
           CAST(floor(quantile_cont(Unique_CDR3_Count, 0.5)) AS BIGINT) AS median_label
    FROM ({RICH_SQL}) GROUP BY Tissue
    UNION ALL
    SELECT 'All', round(quantile_cont(Unique_CDR3_Count, 0.5), 6),
           CAST(floor(quantile_cont(Unique_CDR3_Count, 0.5)) AS BIGINT) FROM ({RICH_SQL})""", "matches"))
def q_richness_median(spark, sf):
    r = _rich(spark, sf)
    # every sample counts for its tissue and for all
    both = r.select("Unique_CDR3_Count", F.explode(F.array("Tissue", F.lit("All"))).alias("Tissue"))
    q = exact_quantiles(both, ["Tissue"], "Unique_CDR3_Count", (0.5,), ("med",))
    return q.select("Tissue", r6("med").alias("median_count"), F.floor("med").cast("bigint").alias("median_label"))


@register("richness_quartiles_by_tissue", "AGG-8 SCL-1", with_ctes(f"""
    SELECT Tissue, round(quantile_cont(lv, 0.25), 6) AS q25, round(quantile_cont(lv, 0.5), 6) AS q50,
           round(quantile_cont(lv, 0.75), 6) AS q75
    FROM (SELECT Tissue, log10(Unique_CDR3_Count + 1) AS lv FROM ({RICH_SQL})) GROUP BY Tissue""", "matches"))
def q_richness_quartiles(spark, sf):
    q = exact_quantiles(_rich(spark, sf), ["Tissue"], "Log_Value", (0.25, 0.5, 0.75), ("q25", "q50", "q75"))
    return q.select("Tissue", *[r6(c).alias(c) for c in ("q25", "q50", "q75")])


@register("richness_describe_by_tissue", "AGG-7", with_ctes(f"""
    SELECT Tissue, count(Unique_CDR3_Count) AS count, round(avg(Unique_CDR3_Count), 6) AS mean,
           round(stddev_samp(Unique_CDR3_Count), 6) AS std, round(min(Unique_CDR3_Count), 6) AS min,
           round(quantile_cont(Unique_CDR3_Count, 0.25), 6) AS q25,
           round(quantile_cont(Unique_CDR3_Count, 0.5), 6) AS q50,
           round(quantile_cont(Unique_CDR3_Count, 0.75), 6) AS q75, round(max(Unique_CDR3_Count), 6) AS max
    FROM ({RICH_SQL}) GROUP BY Tissue""", "matches"))
def q_richness_describe(spark, sf):
    d = R.describe_exact(_rich(spark, sf), "Unique_CDR3_Count", by=["Tissue"])
    return d.select("Tissue", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


@register("length_spectrum_total", "AGG-9 SEQ-8 FLT-2", with_ctes("""
    SELECT CAST(length(CDR3_match) AS INTEGER) AS length, count(*) AS n FROM matches
    WHERE length(CDR3_match) > 5 AND length(CDR3_match) < 30 GROUP BY 1""", "matches"))
def q_length_total(spark, sf):
    return P.length_spectrum(fx.matches(spark, sf), "total")


@register("length_spectrum_unique", "AGG-9 DED-2", with_ctes("""
    SELECT CAST(length(CDR3_match) AS INTEGER) AS length, count(*) AS n
    FROM (SELECT DISTINCT sample, CDR3_match FROM matches)
    WHERE length(CDR3_match) > 5 AND length(CDR3_match) < 30 GROUP BY 1""", "matches"))
def q_length_unique(spark, sf):
    return P.length_spectrum(fx.matches(spark, sf), "unique")


@register("sample_name_normalise", "SRC-7", with_ctes("""
    SELECT raw_name, replace(replace(replace(raw_name, 'matched_', ''), '.dedup', ''), '.parquet', '') AS sample
    FROM (SELECT DISTINCT 'matched_' || sample || '.dedup.parquet' AS raw_name FROM matches)""", "matches"))
def q_sample_name(spark, sf):
    m = fx.matches(spark, sf).select(F.concat(F.lit("matched_"), "sample", F.lit(".dedup.parquet")).alias("raw_name"))
    return m.distinct().select("raw_name", S.normalise_sample_name(F.col("raw_name")).alias("sample"))


_BLOOD = "SELECT patient_id, Run, Disease FROM metadata WHERE ord % 2 = 1"
_BIOPSY = "SELECT patient_id, Run, Disease FROM metadata WHERE ord % 2 = 0"


@register("cohort_outer_join", "JN-1 PRJ-1", with_ctes(f"""
    SELECT coalesce(b.patient_id, s.patient_id) AS patient_id, b.Run AS Run_blood, b.Disease AS Disease_blood,
           s.Run AS Run_biopsy, s.Disease AS Disease_biopsy
    FROM ({_BLOOD}) b FULL OUTER JOIN ({_BIOPSY}) s ON b.patient_id IS NOT DISTINCT FROM s.patient_id""",
    "metadata"))
def q_cohort_outer(spark, sf):
    md = fx.metadata(spark, sf)
    blood = md.where(F.col("ord") % 2 == 1).select("patient_id", "Run", "Disease")
    biopsy = md.where(F.col("ord") % 2 == 0).select("patient_id", "Run", "Disease")
    return R.join_keys(blood, biopsy, "patient_id", "full", null_safe=True, suffixes=("_blood", "_biopsy"))


_RUNTABLE_SQL = """SELECT CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'GSM' || CAST(s_suppkey AS VARCHAR) END AS GSM_ID,
                          'SRX' || CAST(s_suppkey AS VARCHAR) AS Experiment,
                          'SRR' || CAST(1000 + s_suppkey AS VARCHAR) AS Run_acc FROM supplier"""


def _run_table(spark, sf):
    s = fx.table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    return s.select(F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("GSM"), k.cast("string"))).alias("GSM_ID"),
                    F.concat(F.lit("SRX"), k.cast("string")).alias("Experiment"),
                    F.concat(F.lit("SRR"), (F.lit(1000) + k).cast("string")).alias("Run_acc"))


@register("cohort_run_join", "JN-2", with_ctes(f"""
    SELECT l.GSM_ID, l.ord, r.Experiment, r.Run_acc
    FROM (SELECT CASE WHEN ord % 13 = 0 THEN NULL ELSE 'GSM' || CAST(ord AS VARCHAR) END AS GSM_ID, ord FROM metadata) l
    LEFT JOIN ({_RUNTABLE_SQL}) r ON l.GSM_ID IS NOT DISTINCT FROM r.GSM_ID""", "metadata"))
def q_cohort_run(spark, sf):
    md = fx.metadata(spark, sf)
    left = md.select(F.when(F.col("ord") % 13 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("GSM"), F.col("ord").cast("string"))).alias("GSM_ID"), "ord")
    return R.join_keys(left, _run_table(spark, sf), "GSM_ID", "left", null_safe=True) \
        .select("GSM_ID", "ord", "Experiment", "Run_acc")


_SAMPLE_FILES = "SELECT DISTINCT 'matched_' || sample || '.dedup.parquet' AS sample_file FROM matches"


@register("sample_to_run", "JN-3 WIN-1", with_ctes(f"""
    SELECT s.sample_file, arg_min(m.Run, m.ord) AS matched_id
    FROM ({_SAMPLE_FILES}) s LEFT JOIN metadata m ON contains(s.sample_file, m.Run)
    GROUP BY s.sample_file""", "matches", "metadata"))
def q_sample_to_run(spark, sf):
    files = fx.matches(spark, sf).select(
        F.concat(F.lit("matched_"), "sample", F.lit(".dedup.parquet")).alias("sample_file"))
    return R.first_containing(files, "sample_file", fx.metadata(spark, sf), "Run", "ord")


_RICH_MD_SQL = f"""
    SELECT sample, Unique_CDR3_Count, Tissue, Run, Disease, ord,
           CASE WHEN lower(coalesce(Disease, 'nan')) LIKE '%control%' THEN 'Control'
                WHEN lower(coalesce(Disease, 'nan')) LIKE '%uc%' THEN 'UC'
                WHEN lower(coalesce(Disease, 'nan')) LIKE '%cd%' THEN 'CD'
                ELSE coalesce(Disease, 'nan') END AS Condition
    FROM (SELECT r.*, m.Run, m.Disease, m.ord,
                 row_number() OVER (PARTITION BY r.sample ORDER BY m.ord) AS rn
          FROM ({RICH_SQL}) r
          JOIN (SELECT s.sample_file, arg_min(m.Run, m.ord) AS matched_id
                FROM (SELECT DISTINCT sample AS sample_file FROM matches) s
                LEFT JOIN metadata m ON contains(s.sample_file, m.Run) GROUP BY 1) l ON l.sample_file = r.sample
          JOIN metadata m ON m.Run = l.matched_id)
    WHERE rn = 1"""


def _rich_md(spark, sf):
    r = _rich(spark, sf)
    md = fx.metadata(spark, sf)
    link = R.first_containing(r, "sample", md, "Run", "ord")
    j = r.join(link, "sample").join(md, F.col("matched_id") == F.col("Run"), "inner")
    j = R.keep_first(j, "sample", "ord")
    return j.select("sample", "Unique_CDR3_Count", "Tissue", "Run", "Disease", "ord",
                    S.recode_condition(F.col("Disease")).alias("Condition"))


@register("richness_with_metadata", "JN-4 DED-1 SCL-9", with_ctes(_RICH_MD_SQL, "matches", "metadata"))
def q_richness_md(spark, sf):
    return _rich_md(spark, sf)


@register("condition_stats", "FLT-5 AGG-6 AGG-5 AGG-8", with_ctes(f"""
    SELECT Tissue, Condition, count(*) AS n, round(quantile_cont(Unique_CDR3_Count, 0.5), 6) AS median_count,
           round(quantile_cont(log10(Unique_CDR3_Count + 1), 0.25), 6) AS q25_log,
           round(quantile_cont(log10(Unique_CDR3_Count + 1), 0.75), 6) AS q75_log
    FROM ({_RICH_MD_SQL}) WHERE Condition IN ('Control', 'UC', 'CD') GROUP BY Tissue, Condition""",
    "matches", "metadata"))
def q_condition_stats(spark, sf):
    d = _rich_md(spark, sf).where(F.col("Condition").isin("Control", "UC", "CD"))
    d = materialize(d.select("Tissue", "Condition", "Unique_CDR3_Count", S.log10_plus1(F.col("Unique_CDR3_Count")).alias("lv")))
    by = ["Tissue", "Condition"]
    # both values of a group in one search: (group, which value)
    long = d.select(*by, F.inline(F.array(F.struct(F.lit("count").alias("of"), F.col("Unique_CDR3_Count").cast("double").alias("x")),
                                          F.struct(F.lit("log").alias("of"), F.col("lv").alias("x")))))
    q = materialize(exact_quantiles(long, [*by, "of"], "x", (0.25, 0.5, 0.75), ("q25", "q50", "q75")))
    one = q.groupBy(*by).agg(F.max(F.when(F.col("of") == "count", F.col("q50"))).alias("median_count"),
                             *[F.max(F.when(F.col("of") == "log", F.col(c))).alias(f"{c}_log") for c in ("q25", "q75")])
    n = d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return n.join(one, by).select(*by, "n", *[r6(c).alias(c) for c in ("median_count", "q25_log", "q75_log")])


_COUNTS_SQL = """SELECT sample, CDR3_match AS sequence, CAST(coalesce(sum(count), 0) AS BIGINT) AS count
                 FROM matches WHERE CDR3_match IS NOT NULL GROUP BY 1, 2"""
_PROD_SQL = f"SELECT * FROM ({_COUNTS_SQL}) WHERE sequence LIKE 'C%'"
_TOP_SQL = f"""SELECT sequence, count(DISTINCT sample) AS n_samples FROM ({_PROD_SQL}) GROUP BY 1
               ORDER BY n_samples DESC, sequence ASC LIMIT 600"""


@register("sequence_counts", "AGG-2 PVT-3", with_ctes(_COUNTS_SQL, "matches"))
def q_sequence_counts(spark, sf):
    return P.sequence_counts(fx.matches(spark, sf))


@register("prevalence", "AGG-3 SEQ-9", with_ctes(
    f"SELECT sequence, count(DISTINCT sample) AS n_samples FROM ({_PROD_SQL}) GROUP BY 1", "matches"))
def q_prevalence(spark, sf):
    return P.prevalence(P.productive(P.sequence_counts(fx.matches(spark, sf))))


@register("top_sequences", "TOP-1 SRT-1", with_ctes(_TOP_SQL, "matches"))
def q_top(spark, sf):
    return P.top_sequences(P.productive(P.sequence_counts(fx.matches(spark, sf))), 600)


@register("sample_depth", "AGG-4", with_ctes(
    "SELECT sample, CAST(sum(count) AS BIGINT) AS depth FROM matches GROUP BY 1", "matches"))
def q_depth(spark, sf):
    return P.depth(fx.matches(spark, sf))


@register("feature_matrix_v1", "PVT-1 JN-15", with_ctes(f"""
    SELECT sample, sequence, round(CAST(count AS DOUBLE), 6) AS value FROM ({_PROD_SQL})
    WHERE sequence IN (SELECT sequence FROM ({_TOP_SQL}))""", "matches"))
def q_matrix_v1(spark, sf):
    m = P.feature_matrix_long(fx.matches(spark, sf), 600, normalise=False)
    return m.select("sample", "sequence", r6("value").alias("value"))


@register("feature_matrix_v2", "PVT-2 JN-14 WIN-2", with_ctes(f"""
    SELECT sample, sequence, round(count / sum(count) OVER (PARTITION BY sample), 6) AS value
    FROM ({_PROD_SQL}) QUALIFY sequence IN (SELECT sequence FROM ({_TOP_SQL}))""", "matches"))
def q_matrix_v2(spark, sf):
    m = P.feature_matrix_long(fx.matches(spark, sf), 600, normalise=True)
    return m.select("sample", "sequence", r6("value").alias("value"))


@register("feature_matrix_wide", "PVT-1 PVT-5", with_ctes(f"""
    SELECT s.sample, t.sequence, coalesce(CAST(p.count AS DOUBLE), 0.0) AS value
    FROM (SELECT DISTINCT sample FROM ({_PROD_SQL}) WHERE sequence IN (SELECT sequence FROM ({_TOP_SQL}))) s
    CROSS JOIN (SELECT sequence FROM ({_TOP_SQL})) t
    LEFT JOIN ({_PROD_SQL}) p ON p.sample = s.sample AND p.sequence = t.sequence""", "matches"))
def q_matrix_wide(spark, sf):
    """The wide matrix, unpivoted with its zeros so that any engine can compare it."""
    long = P.productive(P.sequence_counts(fx.matches(spark, sf)))
    long = long.withColumn("value", F.col("count").cast("double"))
    top = P.top_sequences(long, 600)
    cols = [r["sequence"] for r in top.collect()]          # bounded: top-N names
    return P.pivot_matrix(P.restrict_to(long, top), cols).unpivot("sample", [F.col(f"`{c}`") for c in cols], "sequence", "value")


@register("target_guard", "FLT-7 AGG-13", with_ctes("""
    SELECT 'Disease' AS target, count(*) AS n_rows, count(*) FILTER (WHERE Disease IS NULL) AS n_null,
           count(DISTINCT Disease) AS n_distinct,
           count(*) FILTER (WHERE Disease IS NULL) <= count(*) * 0.5 AS ok FROM metadata
    UNION ALL
    SELECT 'target', count(*), count(*) FILTER (WHERE target IS NULL), count(DISTINCT target),
           count(*) FILTER (WHERE target IS NULL) <= count(*) * 0.5 FROM metadata""", "metadata"))
def q_target_guard(spark, sf):
    md = fx.metadata(spark, sf)
    return R.target_guard(md, "Disease").select(F.lit("Disease").alias("target"), "*").unionByName(
        R.target_guard(md, "target").select(F.lit("target").alias("target"), "*"))


@register("metadata_nonnull_target", "FLT-6", with_ctes(
    "SELECT * FROM metadata WHERE Disease IS NOT NULL", "metadata"))
def q_nonnull_target(spark, sf):
    return R.drop_null_target(fx.metadata(spark, sf), "Disease")


@register("matrix_metadata_align", "JN-13", with_ctes(f"""
    SELECT d.sample, m.Disease, m.target, d.n_features,
           (SELECT count(*) FROM (SELECT DISTINCT sample FROM ({_PROD_SQL})) x
             WHERE x.sample NOT IN (SELECT Run FROM metadata WHERE Disease IS NOT NULL)) AS n_unaligned
    FROM (SELECT sample, count(*) AS n_features FROM ({_PROD_SQL}) GROUP BY 1) d
    JOIN (SELECT * FROM metadata WHERE Disease IS NOT NULL) m ON m.Run = d.sample""", "matches", "metadata"))
def q_align(spark, sf):
    long = P.productive(P.sequence_counts(fx.matches(spark, sf)))
    per = long.groupBy("sample").agg(F.count(F.lit(1)).alias("n_features"))
    md = R.drop_null_target(fx.metadata(spark, sf), "Disease")
    missing = per.join(md, per["sample"] == md["Run"], "left_anti").agg(F.count(F.lit(1)).alias("n_unaligned"))
    j = per.join(md, per["sample"] == md["Run"], "inner").select("sample", "Disease", "target", "n_features")
    # attach the one-row report through a constant key (a single-row broadcast)
    return j.withColumn("__k", F.lit(1)).join(F.broadcast(missing.withColumn("__k", F.lit(1))), "__k").drop("__k")


@register("feature_vectors", "PVT-1", with_ctes(f"""
    SELECT p.sample, t.j, CAST(p.count AS DOUBLE) AS value FROM ({_PROD_SQL}) p
    JOIN (SELECT sequence, row_number() OVER (ORDER BY n_samples DESC, sequence) - 1 AS j FROM ({_TOP_SQL})) t
      ON t.sequence = p.sequence WHERE p.count <> 0""", "matches"))
def q_feature_vectors(spark, sf):
    """Scale path of the sample x sequence matrix: one sparse ML vector per sample over the top-N, exploded."""
    from pyspark.ml.functions import vector_to_array

    long = P.productive(P.sequence_counts(fx.matches(spark, sf)))
    long = long.withColumn("value", F.col("count").cast("double"))
    top = P.top_sequences(long, 600)
    v = P.sparse_vectors(P.restrict_to(long, top), top)
    return v.select("sample", F.posexplode(vector_to_array("features")).alias("j", "value")) \
        .where("value <> 0").select("sample", F.col("j").cast("bigint").alias("j"), "value")
