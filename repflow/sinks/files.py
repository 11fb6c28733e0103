"""Sinks, caches and run reports (SNK-1..3, SNK-5..10)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def output_name(source_file) -> F.Column:
    """SNK-1: ``matched_<stem>`` for an input file name."""
    return F.concat(F.lit("matched_"), F.regexp_replace(source_file, r"\.parquet$", ""))


def write_matches(matches: DataFrame, out_dir: str, overwrite: bool = False) -> None:
    """SNK-1/SNK-3: one output partition per input file, all files in one job.

    ``matches`` carries ``source_file``.  With ``overwrite`` only the
    partitions present in this run are replaced (dynamic partition overwrite);
    otherwise new partitions are appended.
    """
    out = matches.withColumn("output", output_name(F.col("source_file"))).drop("source_file")
    # REBALANCE groups rows of one output into few writers (measured 25 s -> 7.5 s at
    # sf0.1 against every task writing every output); AQE splits a hot output's
    # partition above the advisory size, so a skewed input file is not one task.
    out = out.hint("rebalance", "output")
    out.write.mode("overwrite" if overwrite else "append").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("output").parquet(out_dir)


def drop_outputs(spark: SparkSession, out_dir: str, sources: DataFrame) -> int:
    """Delete the output files of the inputs in ``sources`` (``source_file``); returns how many files went.

    What a rerun of an input leaves behind when it has no hit any more: a dynamic overwrite only replaces
    partitions that receive rows.  File paths come one by one, through the filesystem that holds ``out_dir``.
    """
    written = _read_or_none(spark, out_dir)
    if written is None or "output" not in written.columns:
        return 0
    named = sources.select(output_name(F.col("source_file")).alias("output")).distinct()
    stale = written.select(F.col("output").cast("string").alias("output"), F.col("_metadata.file_path").alias("path")) \
        .join(named, "output", "left_semi").select("path").distinct()
    n = 0
    for row in stale.toLocalIterator():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["path"]))
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False))
    return n


def write_empty(schema, path: str, spark: SparkSession) -> None:
    """SNK-2: a typed, empty table (the schema is kept in the written file)."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


def _read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table at ``path``; None when nothing is there yet.  Any other failure is raised."""
    from pyspark.errors import AnalysisException

    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


COMPLETED = "source_file string, n_reads long, n_matches long"


def completed_outputs(spark: SparkSession, out_dir: str) -> DataFrame:
    """Inputs finished in earlier runs (``source_file``), those without a hit included.

    The run's own table under ``out_dir/_completed`` holds raw file names; output partitions
    (percent-encoded in paths) count as well, a write job commits all of its outputs or none.
    """
    names = spark.createDataFrame([], "source_file string")
    done = _read_or_none(spark, f"{out_dir.rstrip('/')}/_completed", COMPLETED)
    if done is not None:
        names = names.union(done.select("source_file"))
    written = _read_or_none(spark, out_dir)
    if written is not None:
        stem = F.regexp_extract(F.col("_metadata.file_path"), r"output=matched_([^/]+)/", 1)
        plus = lambda c: F.replace(c, F.lit("+"), F.lit("%2B"))
        # encoded as a partition folder, then as a path
        names = names.union(written.select(F.concat(F.url_decode(plus(F.url_decode(plus(stem)))), F.lit(".parquet"))))
    return names.distinct()


def mark_completed(report: DataFrame, out_dir: str) -> None:
    """Append the analysed files of a run's report to the table of finished inputs."""
    report.where("status = 'analysed'").select(F.expr("source_file"), F.col("n_reads").cast("long"), F.col("n_matches").cast("long")) \
        .coalesce(1).write.mode("append").parquet(f"{out_dir.rstrip('/')}/_completed")


def pending_inputs(inputs: DataFrame, spark: SparkSession, out_dir: str, overwrite: bool = False) -> DataFrame:
    """SNK-3: inputs (``name`` column) to process: all with ``overwrite``, else the anti-join."""
    if overwrite:
        return inputs
    done = completed_outputs(spark, out_dir)
    return inputs.join(done, inputs["name"] == done["source_file"], "left_anti")


def run_report(inputs: DataFrame, reads: DataFrame, matches: DataFrame) -> DataFrame:
    """SNK-5: per input file ``status, n_reads, n_matches`` and the summary by status.

    Files listed but producing no read rows are ``empty_or_unreadable``
    (``ignoreCorruptFiles`` skips unreadable ones silently, so they are found
    by this anti-join rather than by an exception).
    """
    nr = reads.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_reads"))
    nm = matches.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_matches"))
    r = inputs.select(F.col("name").alias("source_file")).join(nr, "source_file", "left").join(nm, "source_file", "left")
    r = r.fillna(0, ["n_reads", "n_matches"])
    return r.withColumn("status", F.when(F.col("n_reads") == 0, "empty_or_unreadable").otherwise("analysed"))


def write_csv(df: DataFrame, path: str, files: int = 1) -> None:
    """SNK-6: CSV with header; ``files`` > 0 asks for that many files (1 for report-sized tables), 0 keeps the tasks."""
    (df.coalesce(files) if files else df).write.mode("overwrite").option("header", "true").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """SNK-7: JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def input_fingerprint(spark: SparkSession, path: str, extra: str = "", config: dict | None = None, metadata_path: str | None = None) -> str:
    """SNK-8: first 12 hex of SHA-1 over the files' (name, size, mtime), ``config``, the metadata file and ``extra``.

    The files' own SHA-1 digests are added up in four parts (a sum does not depend on the order, so no task or
    driver holds the listing); with the number of files the sums stand for the set.  ``config`` counts by its sorted JSON.
    """
    import hashlib
    import json

    def state(p: str) -> str:
        one = F.sha1(F.concat_ws("|", F.element_at(F.split("path", "/"), -1), F.col("length").cast("string"),
                                 F.col("modificationTime").cast("double").cast("string")))
        parts = [F.sum(F.conv(F.substring(one, 1 + 10 * i, 10), 16, 10).cast("decimal(38,0)")) for i in range(4)]
        row = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p).select("path", "length", "modificationTime") \
            .agg(F.count(F.lit(1)), *parts).first()
        return "/".join(map(str, row))

    told = [state(path), json.dumps(config or {}, sort_keys=True, default=str), state(metadata_path) if metadata_path else "", extra]
    return hashlib.sha1("#".join(told).encode()).hexdigest()[:12]


def cached_table(spark: SparkSession, cache_root: str, key: str, builder: Callable[[], DataFrame],
                 force: bool = False) -> DataFrame:
    """SNK-9: read-through parquet cache under ``cache_root/key`` (``force`` rebuilds)."""
    path = f"{cache_root.rstrip('/')}/{key}"
    known = None if force else _read_or_none(spark, path)
    if known is not None:
        return known
    builder().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_run(path: str, model, selected: list[str], scaler=None, spark: SparkSession | None = None) -> None:
    """SNK-10: a fitted model, its scaler and the selected features, each in its own folder under ``path``."""
    spark = spark or SparkSession.active()
    base = path.rstrip("/")
    model.write().overwrite().save(f"{base}/model")
    if scaler is not None:
        scaler.write().overwrite().save(f"{base}/scaler")
    rows = [(i, str(f)) for i, f in enumerate(selected)]                     # a bounded list: the model's inputs
    spark.createDataFrame(rows, "ord int, feature string").coalesce(1).write.mode("overwrite").parquet(f"{base}/selected")


def load_run(path: str, model_class, scaler_class=None, spark: SparkSession | None = None):
    """``(model, selected features in order, scaler or None)`` of :func:`save_run`."""
    spark = spark or SparkSession.active()
    base = path.rstrip("/")
    selected = [r["feature"] for r in spark.read.parquet(f"{base}/selected").orderBy("ord").collect()]
    return model_class.load(f"{base}/model"), selected, scaler_class.load(f"{base}/scaler") if scaler_class else None


def save_model(model, path: str) -> None:
    """SNK-10: persist a fitted ``pyspark.ml`` model or pipeline."""
    model.write().overwrite().save(path)
