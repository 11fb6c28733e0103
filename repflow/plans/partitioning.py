"""Partitioning helpers shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a small input over the cores before CPU-heavy row work.

    A large scan already arrives in more splits than cores and is returned
    unchanged (no shuffle); only an input that the planner estimates at less than
    one split per core is redistributed.  The estimate starts no job.  An explicit
    partition count is kept by AQE (it only coalesces shuffles it introduced itself).
    """
    if df.isStreaming:          # micro-batches: partitioning follows the file source
        return df
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(target) if estimate < target * split else df


def sorted_pieces(df: DataFrame, order: str, piece_bytes: int = 4 << 20) -> DataFrame:
    """``df`` in order of ``order`` over its partitions, which are more than the session's for a table of many ``piece_bytes``.

    The size is the planner's estimate (of a scan: compressed bytes) and starts no job.
    """
    n = -(-int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // piece_bytes)
    if n <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.orderBy(order)
    return df.repartitionByRange(min(n, 100_000), order).sortWithinPartitions(order)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the session's checkpoint dir and cut its lineage.

    Used where one derived table feeds many branches of a plan (the
    normalised expression matrix): without it every branch re-derives the
    whole chain of filters and self-joins.  Reliable storage, so it survives
    executor loss; never ``localCheckpoint``.
    """
    from repflow.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist()
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet to the session's shared folder and read it back.

    For large tables of which several steps read a few columns each: nothing is held in memory meanwhile, and the
    planner knows the size of what it joins.
    """
    from repflow.session import shared_dir

    path = shared_dir(df.sparkSession, f"stored-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
