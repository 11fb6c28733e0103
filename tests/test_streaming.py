from pyspark.sql import types as T

from repflow.operators import sequence as seq
from repflow.streaming.incremental import match_stream


def test_singlecell_stream_equals_batch_and_resumes(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("sequence", "seq_id", "UMI", "CB")])
    rows = [("TGGTGGAAATGGTGG", "a", "U1", "Z:BC1-1"), ("ATGTGGTGGTGG", "b", "U2", "Z:BC2-1"),
            ("CCCAAAGGG", "c", "U3", None)]
    pats = spark.createDataFrame([("WW",), ("MWW",), ("PKG",)], "`CDR3.aa` string")
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    spark.createDataFrame(rows[:2], schema).coalesce(1).write.parquet(src)
    match_stream(spark, src, pats, out, ckpt, schema, id_col="seq_id", mode="singlecell")
    spark.createDataFrame(rows[2:], schema).coalesce(1).write.mode("append").parquet(src)
    match_stream(spark, src, pats, out, ckpt, schema, id_col="seq_id", mode="singlecell")
    match_stream(spark, src, pats, out, ckpt, schema, id_col="seq_id", mode="singlecell")
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("seq_id", "CDR3_match", "UMI", "CB").collect())
    batch = seq.match_single_cell(spark.createDataFrame(rows, schema), pats)
    want = sorted(tuple(r) for r in batch.collect())
    assert got == want and len(got) > 0
