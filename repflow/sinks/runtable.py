"""A match table in versions (SNK-1, SNK-3, SNK-4, SET-5): readers follow a log of commits.

    <path>/data/commit=<id>/part-...     rows of one commit, with ``source_file`` and ``output`` (the matched name)
    <path>/log/commit=<id>/part-...      the files it finished: ``source_file, seq, gen, n_matches``

A commit writes its rows first and its log entries last, each as one overwriting write job of its own folder, so a
run killed in between leaves nothing that readers see, and the same commit repeated replaces what it left.  Of a file
finished by several commits only the last one counts, also when that one has no rows: nothing stale is read.
Compaction is a commit of the live rows in few files; it takes the place of what it replaces in the order (``gen``
counts compactions), so a commit made meanwhile stays above it.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repflow.sinks.files import _read_or_none, output_name

LOG = "source_file string, seq long, gen int, n_matches long, commit string"


def commit_log(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, seq, gen, n_matches, commit`` of every finished file, all commits; empty for a new table."""
    found = _read_or_none(spark, f"{path.rstrip('/')}/log", LOG)
    return found if found is not None else spark.createDataFrame([], LOG)


def live_files(spark: SparkSession, path: str) -> DataFrame:
    """The last commit of every file: ``source_file, commit, seq, gen, n_matches``."""
    last = F.max(F.struct("seq", "gen", "commit", "n_matches"))
    return commit_log(spark, path).groupBy("source_file").agg(last.alias("l")).select("source_file", "l.*")


def commit(rows: DataFrame, files: DataFrame, path: str, name: str | None = None, seq: int | None = None) -> str:
    """Write ``rows`` (with ``source_file``) and finish ``files`` (``source_file``); returns the commit's name.

    ``name`` makes the commit repeatable: a second one of that name replaces the first.  ``seq`` orders commits; by
    default it follows the largest one of the other commits.
    """
    spark, base = rows.sparkSession, path.rstrip("/")
    name = name or uuid.uuid4().hex
    if seq is None:
        seq = (commit_log(spark, path).where(F.col("commit") != name).agg(F.max("seq")).first()[0] or 0) + 1
    out = rows.withColumn("output", output_name(F.col("source_file"))).hint("rebalance", "output")
    out.write.mode("overwrite").parquet(f"{base}/data/commit={name}")
    found = spark.read.parquet(f"{base}/data/commit={name}").groupBy("source_file").agg(F.count(F.lit(1)).alias("n_matches"))
    entries = files.select("source_file").distinct().join(found, "source_file", "left").select(
        "source_file", F.lit(seq).cast("long").alias("seq"), F.lit(0).alias("gen"), F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"))
    entries.coalesce(1).write.mode("overwrite").parquet(f"{base}/log/commit={name}")          # one row per file
    return name


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    """The live rows, with ``source_file`` and ``output``; ``ValueError`` before the first commit."""
    data = _read_or_none(spark, f"{path.rstrip('/')}/data")
    if data is None:
        raise ValueError(f"no commit at {path} yet")
    live = live_files(spark, path).select("source_file", "commit")
    return data.withColumn("commit", F.col("commit").cast("string")).join(live, ["source_file", "commit"], "left_semi").drop("commit")


def compact(spark: SparkSession, path: str, rows_per_file: int = 1_000_000) -> int:
    """Rewrite all live rows as one commit of files of about ``rows_per_file`` rows; returns their number.

    Earlier commits stay on disk for readers that began before.
    """
    base, live = path.rstrip("/"), live_files(spark, path).where("n_matches > 0")
    n, gen = live.agg(F.sum("n_matches"), F.max("gen")).first()
    if not n:
        return 0
    name = f"compact-{uuid.uuid4().hex}"
    entries = live.select("source_file", "seq", F.lit(gen + 1).alias("gen"), "n_matches")
    rows = read_matches(spark, path)
    dealt = rows.repartitionByRange(max(1, math.ceil(n / rows_per_file)), "output", F.xxhash64(*rows.columns))
    dealt.write.mode("overwrite").parquet(f"{base}/data/commit={name}")
    entries.coalesce(1).write.mode("overwrite").parquet(f"{base}/log/commit={name}")
    return n
