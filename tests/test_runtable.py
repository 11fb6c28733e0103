"""Versioned match table: commits, kills between write and log, compaction, streams."""

import pytest
from pyspark.sql import functions as F

from repflow.sinks import runtable as RT

ROWS = "read_id string, CDR3_match string, count long, source_file string"


def _rows(df):
    return sorted(tuple(r) for r in df.select("read_id", "CDR3_match", "count", "source_file", "output").collect())


def _files(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "source_file string")


def test_reruns_replace_and_leave_nothing_stale(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        RT.read_matches(spark, path)
    one = spark.createDataFrame([("r1", "WW", 1, "a.parquet"), ("r2", "WW", None, "b.parquet")], ROWS)
    RT.commit(one, _files(spark, "a.parquet", "b.parquet", "none.parquet"), path)
    assert _rows(RT.read_matches(spark, path)) == [("r1", "WW", 1, "a.parquet", "matched_a"), ("r2", "WW", None, "b.parquet", "matched_b")]
    assert {r["source_file"]: r["n_matches"] for r in RT.live_files(spark, path).collect()} == {"a.parquet": 1, "b.parquet": 1, "none.parquet": 0}
    RT.commit(one.limit(0), _files(spark, "a.parquet"), path)                  # a no longer hits
    assert _rows(RT.read_matches(spark, path)) == [("r2", "WW", None, "b.parquet", "matched_b")]
    RT.commit(one.where("source_file = 'a.parquet'"), _files(spark, "a.parquet"), path)
    assert len(_rows(RT.read_matches(spark, path))) == 2


def test_killed_between_rows_and_log(spark, tmp_path):
    path = str(tmp_path / "t")
    files = _files(spark, "a.parquet")
    first = spark.createDataFrame([("r1", "WW", 1, "a.parquet")], ROWS)
    RT.commit(first, files, path, "batch-0", 1)
    half = spark.createDataFrame([("r9", "XX", 1, "a.parquet"), ("r8", "XX", 1, "a.parquet")], ROWS)
    half.withColumn("output", F.lit("matched_a")).write.parquet(f"{path}/data/commit=batch-1")         # rows without a log entry
    assert [r[0] for r in _rows(RT.read_matches(spark, path))] == ["r1"]
    for _ in range(2):                                                           # the batch again, and once more
        RT.commit(half.limit(1), files, path, "batch-1", 2)
        assert len(_rows(RT.read_matches(spark, path))) == 1 and _rows(RT.read_matches(spark, path))[0][1] == "XX"


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(6):
        df = spark.createDataFrame([(f"r{i}", "WW", i, f"f{i}.parquet")] * 3, ROWS)
        RT.commit(df, _files(spark, f"f{i}.parquet", f"empty{i}.parquet"), path)
    before = _rows(RT.read_matches(spark, path))

    def files():
        live = {r["commit"] for r in RT.live_files(spark, path).where("n_matches > 0").collect()}
        return sum(len(list((tmp_path / "t" / "data" / f"commit={c}").glob("part-*"))) for c in live)

    assert files() >= 6 and RT.compact(spark, path) == 18
    assert files() == 1 and _rows(RT.read_matches(spark, path)) == before
    RT.commit(spark.createDataFrame([], ROWS), _files(spark, "f0.parquet"), path)           # a later commit stays above
    assert len(_rows(RT.read_matches(spark, path))) == 15
    assert RT.compact(spark, path, rows_per_file=4) == 15 and 1 < files() <= 4
    assert {r["source_file"] for r in RT.live_files(spark, path).where("n_matches = 0").collect()} >= {"f0.parquet", "empty3.parquet"}
    assert RT.compact(spark, str(tmp_path / "new")) == 0


def test_stream_into_the_table(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from repflow.streaming.incremental import match_stream_versioned

    src, table, ckpt = (str(tmp_path / n) for n in ("in", "t", "ckpt"))
    schema = StructType([StructField("sequence", StringType()), StructField("read_id", StringType()), StructField("count", LongType())])
    pats = spark.createDataFrame([("WW",)], "`CDR3.aa` string")
    spark.createDataFrame([("TGGTGG", "r1", 2)], schema).coalesce(1).write.parquet(src)
    spark.createDataFrame([("AAAAAA", "r2", 2)], schema).coalesce(1).write.mode("append").parquet(src)
    match_stream_versioned(spark, src, pats, table, ckpt, schema, max_files_per_trigger=1)
    got = RT.read_matches(spark, table).collect()
    assert {(r["CDR3_match"], r["count"]) for r in got} == {("WW", 2)} and RT.live_files(spark, table).count() == 2
    n = len(got)
    spark.createDataFrame([("TGGTGG", "r3", 5)], schema).coalesce(1).write.mode("append").parquet(src)
    match_stream_versioned(spark, src, pats, table, ckpt, schema)
    match_stream_versioned(spark, src, pats, table, ckpt, schema)               # nothing new
    assert RT.read_matches(spark, table).count() == 2 * n and RT.live_files(spark, table).count() == 3
