"""SNK-4: resumable, incremental matching as a file-source stream.

New read files in ``input_dir`` are matched and written per input file; the
checkpoint records which files were consumed, so a rerun after a failure or
after new files arrive processes only what is new (file-level resume, the
role shards play in the reference).  ``availableNow`` makes it a finite batch
run that still goes through the streaming checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repflow.operators import sequence as seq
from repflow.sinks.files import output_name
from repflow.sources.files import raw_name


def match_stream_versioned(spark: SparkSession, input_dir: str, patterns: DataFrame, table_dir: str, checkpoint_dir: str, schema,
                           pattern_col: str = "CDR3.aa", seq_col: str = "sequence", id_col: str = "read_id",
                           max_files_per_trigger: int = 64) -> None:
    """One ``availableNow`` pass into a versioned match table (:mod:`repflow.sinks.runtable`).

    Every micro-batch is one commit named by its number: a batch that is run again after a failure replaces what
    it left.  Files without a hit are finished too.
    """
    from repflow.sinks import runtable as RT

    index = seq.index_patterns(patterns, pattern_col)
    carry = [c for c in ("count",) if c in schema.fieldNames()]
    reads = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
             .parquet(input_dir).withColumn("source_file", raw_name("_metadata.file_name")))

    def take(batch: DataFrame, number: int) -> None:
        hits = seq.find_occurrences(seq.frames(batch, seq_col, keep=[id_col, *carry, "source_file"]), index)
        rows = hits.select(seq._frame_id(id_col).alias("read_id"), "CDR3_match", *carry, "source_file")
        RT.commit(rows, batch.select("source_file"), table_dir, f"batch-{number}", number + 1)

    reads.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start().awaitTermination()


def match_stream(spark: SparkSession, input_dir: str, patterns: DataFrame, output_dir: str,
                 checkpoint_dir: str, schema, pattern_col: str = "CDR3.aa", seq_col: str = "sequence",
                 id_col: str = "read_id", max_files_per_trigger: int = 64, mode: str = "bulk",
                 umi_col: str = "UMI", cb_col: str = "CB") -> None:
    """Run one ``availableNow`` pass over the files not yet in the checkpoint.

    ``mode="bulk"`` writes ``read_id, CDR3_match[, count]``; ``mode="singlecell"``
    writes ``<id>, CDR3_match, <umi>, <cb>`` (the id keeps its input name).
    """
    index = seq.index_patterns(patterns, pattern_col)          # static, broadcast side
    reads = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
             .parquet(input_dir).withColumn("source_file", F.col("_metadata.file_name")))
    if mode == "bulk":
        carry = [c for c in ("count",) if c in schema.fieldNames()]
        fr = seq.frames(reads, seq_col, keep=[id_col, *carry, "source_file"])
        hits = seq.find_occurrences(fr, index)
        out = hits.select(seq._frame_id(id_col).alias("read_id"), "CDR3_match", *carry,
                          output_name(F.col("source_file")).alias("output"))
    elif mode == "singlecell":
        fr = seq.frames(reads, seq_col, keep=[id_col, umi_col, cb_col, "source_file"])
        hits = seq.find_occurrences(fr, index)
        out = hits.select(seq._frame_id(id_col).alias(id_col), "CDR3_match", umi_col, cb_col,
                          output_name(F.col("source_file")).alias("output"))
    else:
        raise ValueError("mode must be 'bulk' or 'singlecell'")
    q = (out.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir)
         .option("path", output_dir).partitionBy("output").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
