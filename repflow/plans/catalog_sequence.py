"""Registered queries: sequence layer (SRC-1, SEQ-1..9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from repflow.operators import sequence as seq
from repflow.plans import fixtures as fx
from repflow.plans.oracle import with_ctes
from repflow.plans.registry import register
from repflow.sources.patterns import load_pattern_db


@register("pattern_db", "SRC-1 SEQ-3", with_ctes("SELECT DISTINCT aa AS pattern FROM pats", "pats"))
def q_pattern_db(spark, sf):
    return load_pattern_db(fx.patterns(spark, sf), "CDR3.aa")


@register("six_frames", "SEQ-1 SEQ-7 SCL-11", with_ctes(
    "SELECT read_id, strand, frame, protein FROM frames", "frames"))
def q_six_frames(spark, sf):
    return seq.frames(fx.reads(spark, sf), keep=["read_id"])


@register("bulk_match", "SEQ-2 SEQ-3 SEQ-4 SEQ-5", with_ctes(
    "SELECT read_id || '|' || strand || CAST(frame AS VARCHAR) AS read_id, CDR3_match, count FROM hits",
    "hits"))
def q_bulk_match(spark, sf):
    return seq.match_bulk(fx.reads(spark, sf), fx.patterns(spark, sf))


@register("sc_match", "SEQ-6", with_ctes(
    "SELECT read_id || '|' || strand || CAST(frame AS VARCHAR) AS seq_id, CDR3_match, UMI, CB FROM hits",
    "hits"))
def q_sc_match(spark, sf):
    reads = fx.reads(spark, sf).withColumnRenamed("read_id", "seq_id")
    return seq.match_single_cell(reads, fx.patterns(spark, sf))


@register("match_richness_per_document", "SEQ-5 AGG-1 SEQ-8", with_ctes("""
    SELECT split_part(read_id, '_', 1) AS sample, count(DISTINCT CDR3_match) AS Unique_CDR3_Count,
           count(*) AS n_hits, CAST(sum(count) AS BIGINT) AS total_count,
           CAST(max(length(CDR3_match)) AS INTEGER) AS max_len
    FROM hits GROUP BY 1""", "hits"))
def q_match_richness(spark, sf):
    m = seq.match_bulk(fx.reads(spark, sf), fx.patterns(spark, sf))
    return m.groupBy(F.split_part("read_id", F.lit("_"), F.lit(1)).alias("sample")).agg(
        F.count_distinct("CDR3_match").alias("Unique_CDR3_Count"), F.count(F.lit(1)).alias("n_hits"),
        F.sum("count").cast("bigint").alias("total_count"),
        F.max(seq.sequence_length(F.col("CDR3_match"))).cast("int").alias("max_len"))


@register("hits_per_frame", "SEQ-2 AGG-11", with_ctes("""
    SELECT strand || CAST(frame AS VARCHAR) AS frame_label, count(*) AS n_hits,
           count(DISTINCT read_id) AS n_reads
    FROM hits GROUP BY 1""", "hits"))
def q_hits_per_frame(spark, sf):
    fr = seq.frames(fx.reads(spark, sf), keep=["read_id"])
    idx = seq.index_patterns(fx.patterns(spark, sf), "CDR3.aa")
    h = seq.find_occurrences(fr, idx)
    return h.groupBy(F.concat("strand", F.col("frame").cast("string")).alias("frame_label")).agg(
        F.count(F.lit(1)).alias("n_hits"), F.count_distinct("read_id").alias("n_reads"))


@register("productive_hits", "SEQ-9 SEQ-8 FLT-2", with_ctes("""
    SELECT CAST(length(CDR3_match) AS INTEGER) AS length, count(*) AS n
    FROM hits WHERE CDR3_match LIKE 'C%' AND length(CDR3_match) > 5 AND length(CDR3_match) < 30
    GROUP BY 1""", "hits"))
def q_productive_hits(spark, sf):
    m = seq.match_bulk(fx.reads(spark, sf), fx.patterns(spark, sf))
    m = m.where(seq.is_productive(F.col("CDR3_match")))
    ln = seq.sequence_length(F.col("CDR3_match"))
    return m.where((ln > 5) & (ln < 30)).groupBy(ln.cast("int").alias("length")).agg(F.count(F.lit(1)).alias("n"))
