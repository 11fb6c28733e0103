"""One match run over a folder: list, skip finished files, scan, match, write, report (SRC-2..5, SNK-1..5, SET-5)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repflow.operators import sequence as seq
from repflow.plans.partitioning import materialize
from repflow.sinks import files as SK
from repflow.sources import files as SF


def match_run(spark: SparkSession, in_dir: str, patterns: DataFrame, out_dir: str, mode: str = "bulk",
              overwrite: bool = False, ignore_corrupt: bool = False, pattern_col: str = "CDR3.aa",
              seq_col: str = "sequence", id_col: str = "read_id", count_col: str = "count", umi_col: str = "UMI",
              cb_col: str = "CB", glob: str = "*.parquet") -> DataFrame:
    """Match every pending read file of ``in_dir`` into ``out_dir``; returns the report.

    Report: ``source_file, status, n_reads, n_matches`` with status ``analysed``,
    ``skipped`` (finished in an earlier run) or ``failed`` (with ``ignore_corrupt``: unreadable, or fewer
    rows read than the footer names; its rows are not written and it stays pending).
    A file without hits is finished too.  A run without any hit leaves a typed
    empty table.  Outputs of the run's files are replaced, so a repeated run adds nothing.
    """
    listed = SF.list_files(spark, in_dir, glob).select("name", "path")
    pending = materialize(SK.pending_inputs(listed, spark, out_dir, overwrite))
    names = pending.select(F.col("name").alias("__pending"))
    if mode == "bulk":
        need, optional = [seq_col, id_col], [count_col]
    elif mode == "singlecell":
        need, optional = [seq_col, id_col, umi_col, cb_col], []
    else:
        raise ValueError("mode must be 'bulk' or 'singlecell'")
    schema = spark.read.option("pathGlobFilter", glob).option("mergeSchema", "true") \
        .option("ignoreCorruptFiles", str(ignore_corrupt).lower()).parquet(in_dir).columns
    carry = [c for c in optional if c in schema]
    reads = SF.scan_with_source(spark, in_dir, [*need, *carry], glob, ignore_corrupt)
    reads = reads.join(names, F.col("source_file") == F.col("__pending"), "left_semi")
    read = reads.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_reads"), F.max(F.length(seq_col)).alias("longest"))
    footers = SF.row_counts(spark, in_dir, glob)
    known = materialize(pending.select(F.col("name").alias("source_file")).join(read, "source_file", "left")
                        .join(footers, "source_file", "left")
                        .select("source_file", F.coalesce("n_reads", F.lit(0)).alias("n_reads"),
                                (F.col("footer_rows").isNotNull() & (F.col("footer_rows") == F.coalesce("n_reads", F.lit(0)))
                                 | (F.col("footer_rows").isNull() & F.lit(not ignore_corrupt) & F.col("n_reads").isNull())).alias("whole")))
    sound = known.where("whole").select(F.col("source_file").alias("__sound"))
    reads = reads.join(sound, F.col("source_file") == F.col("__sound"), "left_semi")
    index = seq.index_patterns(patterns, pattern_col)
    hits = seq.find_occurrences(seq.frames(reads, seq_col, keep=[c for c in (*need[1:], *carry, "source_file")]), index)
    named = seq._frame_id(id_col).alias("read_id" if mode == "bulk" else id_col)
    extra = [F.col(c).cast("bigint").alias(c) for c in carry] if mode == "bulk" else [F.col(c).cast("string").alias(c) for c in (umi_col, cb_col)]
    hits = materialize(hits.select(named, "CDR3_match", *extra, "source_file"))
    if hits.limit(1).count():
        SK.write_matches(hits, out_dir, overwrite=True)       # dynamic: only this run's files are replaced
    if overwrite:       # a file of this run without a hit keeps none of its earlier ones
        without = known.where("whole").join(hits.select("source_file"), "source_file", "left_anti")
        SK.drop_outputs(spark, out_dir, without)
    if SK._read_or_none(spark, out_dir) is None:
        SK.write_empty(hits.withColumn("output", SK.output_name(F.col("source_file"))).drop("source_file").schema, out_dir, spark)
    found = hits.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_matches"))
    done = known.join(found, "source_file", "left").select(
        "source_file", F.when(F.col("whole"), "analysed").otherwise("failed").alias("status"), "n_reads",
        F.coalesce("n_matches", F.lit(0)).alias("n_matches"))
    skipped = listed.join(names, F.col("name") == F.col("__pending"), "left_anti").select(
        F.col("name").alias("source_file"), F.lit("skipped").alias("status"), F.lit(0).cast("long").alias("n_reads"),
        F.lit(0).cast("long").alias("n_matches"))
    report = materialize(done.unionByName(skipped))
    SK.mark_completed(report, out_dir)
    return report


def run_totals(report: DataFrame) -> DataFrame:
    """``found, analysed, skipped, failed`` of a run's report."""
    return report.agg(F.count(F.lit(1)).alias("found"), *[F.count_if(F.col("status") == s).alias(s) for s in ("analysed", "skipped", "failed")])


def merge_shards(spark: SparkSession, out_dir: str, merged_dir: str, rows_per_file: int = 1_000_000) -> DataFrame:
    """SET-5: the union of all match shards under ``out_dir``, rewritten in files of about ``rows_per_file`` rows."""
    shards = spark.read.option("mergeSchema", "true").parquet(out_dir)
    n = shards.count()
    shards.repartition(max(1, math.ceil(n / rows_per_file))).write.mode("overwrite").parquet(merged_dir)
    return spark.read.parquet(merged_dir)
