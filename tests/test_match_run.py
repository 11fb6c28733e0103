"""End-to-end match run: skip, empty outputs, broken files, reruns."""

import os

from repflow.operators.match_run import match_run, merge_shards, run_totals


def _write(spark, folder, name, rows):
    tmp = f"{folder}-tmp-{abs(hash(name))}"
    spark.createDataFrame(rows, "sequence string, read_id string, count bigint").coalesce(1).write.parquet(tmp)
    part = next(x for x in os.listdir(tmp) if x.startswith("part-"))
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(open(f"{tmp}/{part}", "rb").read())


def test_match_run_reruns_broken_files_and_merge(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    pats = spark.createDataFrame([("WW",), ("MWW",)], "`CDR3.aa` string")
    _write(spark, src, "a b.parquet", [("TGGTGGAAATGGTGG", "r1", 2), ("ATGTGGTGG", "r2", None)])
    _write(spark, src, "nohits.parquet", [("AAAAAAAAA", "r3", 1)])
    _write(spark, src, "whole.parquet", [("TGGTGG", f"q{i}", 1) for i in range(20)])
    os.rename(f"{src}/whole.parquet", f"{src}/broken.parquet")
    raw = open(f"{src}/broken.parquet", "rb").read()
    open(f"{src}/broken.parquet", "wb").write(raw[:-30])
    rep = {r["source_file"]: (r["status"], r["n_reads"], r["n_matches"] > 0)
           for r in match_run(spark, src, pats, out, ignore_corrupt=True).collect()}
    assert rep == {"a b.parquet": ("analysed", 2, True), "nohits.parquet": ("analysed", 1, False), "broken.parquet": ("failed", 0, False)}
    first = sorted(tuple(r) for r in spark.read.parquet(out).select("read_id", "CDR3_match", "count", "output").collect())
    assert {r[3] for r in first} == {"matched_a b"}
    # finished files stay finished; the mended one is read
    open(f"{src}/broken.parquet", "wb").write(raw)
    again = match_run(spark, src, pats, out)
    assert {r["source_file"]: r["status"] for r in again.collect()} == {
        "a b.parquet": "skipped", "nohits.parquet": "skipped", "broken.parquet": "analysed"}
    assert tuple(run_totals(again).first()) == (3, 1, 2, 0)
    rows = sorted(tuple(r) for r in spark.read.parquet(out).select("read_id", "CDR3_match", "count", "output").collect())
    assert [r for r in rows if r[3] == "matched_a b"] == first and len(rows) > len(first)
    # overwrite does all files again and adds nothing
    redo = match_run(spark, src, pats, out, overwrite=True)
    assert {r["status"] for r in redo.collect()} == {"analysed"}
    assert sorted(tuple(r) for r in spark.read.parquet(out).select("read_id", "CDR3_match", "count", "output").collect()) == rows
    merged = merge_shards(spark, out, str(tmp_path / "merged"))
    assert merged.count() == len(rows)


def test_run_without_hits_leaves_a_typed_empty_table(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write(spark, src, "x.parquet", [("AAAAAA", "r", 1)])
    match_run(spark, src, spark.createDataFrame([("WW",)], "`CDR3.aa` string"), out)
    empty = spark.read.parquet(out)
    assert empty.count() == 0 and dict(empty.dtypes)["CDR3_match"] == "string" and dict(empty.dtypes)["count"] == "bigint"


def test_overwrite_leaves_no_stale_rows(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write(spark, src, "a b%.parquet", [("TGGTGG", "r1", 1)])
    _write(spark, src, "c.parquet", [("ATGATG", "r2", 1), ("TGGTGG", "r3", 1)])
    first, second = (spark.createDataFrame([(p,)], "`CDR3.aa` string") for p in ("WW", "MM"))
    match_run(spark, src, first, out)
    assert {r["output"] for r in spark.read.parquet(out).collect()} == {"matched_a b%", "matched_c"}
    rep = {r["source_file"]: r["n_matches"] for r in match_run(spark, src, second, out, overwrite=True).collect()}
    rows = spark.read.parquet(out).collect()
    assert rep["a b%.parquet"] == 0 and {(r["output"], r["CDR3_match"]) for r in rows} == {("matched_c", "MM")}
    none = spark.createDataFrame([("KKKK",)], "`CDR3.aa` string")
    match_run(spark, src, none, out, overwrite=True)
    assert spark.read.parquet(out).count() == 0 and "CDR3_match" in spark.read.parquet(out).columns
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
