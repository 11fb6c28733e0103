"""Fixed output schemas and plan-time column checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BULK_MATCH = T.StructType([
    T.StructField("read_id", T.StringType(), True),
    T.StructField("CDR3_match", T.StringType(), True),
])
BULK_MATCH_COUNT = T.StructType(BULK_MATCH.fields + [T.StructField("count", T.LongType(), True)])


def sc_match_schema(id_col: str = "seq_id", umi_col: str = "UMI", cb_col: str = "CB") -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True)
                         for c in (id_col, "CDR3_match", umi_col, cb_col)])


def col_ref(name: str) -> str:
    """Back-quoted column reference, safe for names with dots (``CDR3.aa``)."""
    return "`" + name.replace("`", "``") + "`"


def validate_columns(df: DataFrame, required, what: str = "input") -> None:
    """Raise ``ValueError`` naming the missing columns and the available ones."""
    names = df.schema.names
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"Column(s) {missing} not found in {what}; available: {names}")
