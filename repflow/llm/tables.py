"""Table helpers: reading, cutting lineage, bounded parameters of a run."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repflow.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
BYTES_PER_FILE = 64 << 20                # of the texts, for a file of a table of documents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path under the session's shared checkpoint dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage, survives lost executors).

    ``files`` bounds the number of files of a table that is small for its partitions; the tasks that write it are as many.
    """
    path = scratch(df.sparkSession, name)
    (df.coalesce(files) if files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_files(docs: DataFrame, text_col: str = "text") -> int:
    """Files that the texts of ``docs`` ask for, as many for each core.

    Every file that a task writes costs processes that set its mode, which share the executor's memory until they run.
    """
    n_bytes = int(docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0)
    return even(docs, -(-n_bytes // BYTES_PER_FILE))


def even(df: DataFrame, n: int) -> int:
    """``n`` or a little more: a multiple of the session's cores, so that tasks end together."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-n // cores)) * cores


def crc_mod(col: Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n`` (null id: null)."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(n)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_slices(df: DataFrame, at_least: int = 1) -> int:
    """Shuffle width of the session (the caller sizes it to the data)."""
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
