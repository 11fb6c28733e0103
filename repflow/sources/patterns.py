"""SRC-1: the pattern (CDR3 amino-acid) database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repflow.schema import col_ref, validate_columns

DEFAULT_PATTERN_COL = "CDR3.aa"


def load_pattern_db(source, col: str = DEFAULT_PATTERN_COL, spark: SparkSession | None = None) -> DataFrame:
    """One string column ``pattern``: non-null, distinct (order is not kept).

    ``source`` is a DataFrame or a parquet path (file or folder).  The column
    name may contain dots, so it is always back-quoted.
    """
    if isinstance(source, str):
        spark = spark or SparkSession.getActiveSession()
        source = spark.read.parquet(source)
    validate_columns(source, [col], "pattern DB")
    return source.select(F.col(col_ref(col)).cast("string").alias("pattern")) \
        .where(F.col("pattern").isNotNull()).distinct()
