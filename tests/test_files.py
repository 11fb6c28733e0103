import os

import pytest
from pyspark.sql import functions as F

from repflow.schema import BULK_MATCH_COUNT
from repflow.sinks import files as SK
from repflow.sources import files as SRC


def test_empty_match_table_keeps_schema(spark, tmp_path):
    p = str(tmp_path / "empty")
    SK.write_empty(BULK_MATCH_COUNT, p, spark)
    back = spark.read.parquet(p)
    assert back.count() == 0 and back.schema.names == ["read_id", "CDR3_match", "count"]


def test_skip_existing_unless_overwrite(spark, tmp_path):
    out = str(tmp_path / "out")
    m = spark.createDataFrame([("r|+0", "CAS", 1, "a.parquet")], "read_id string, CDR3_match string, count bigint, source_file string")
    SK.write_matches(m, out)
    inputs = spark.createDataFrame([("a.parquet",), ("b.parquet",)], "name string")
    assert [r["name"] for r in SK.pending_inputs(inputs, spark, out).collect()] == ["b.parquet"]
    assert SK.pending_inputs(inputs, spark, out, overwrite=True).count() == 2


def test_fingerprint_changes_with_inputs(spark, tmp_path):
    d = tmp_path / "in"
    spark.range(3).write.parquet(str(d / "x"))
    k1 = SK.input_fingerprint(spark, str(d))
    assert len(k1) == 12 and k1 == SK.input_fingerprint(spark, str(d))
    spark.range(4).write.parquet(str(d / "y"))
    assert SK.input_fingerprint(spark, str(d)) != k1


def test_list_files_and_missing(spark, tmp_path):
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "f"))
    names = [r["name"] for r in SRC.list_files(spark, str(tmp_path / "f")).collect()]
    assert len(names) == 1 and names[0].endswith(".parquet")
    os.makedirs(tmp_path / "none")
    with pytest.raises(Exception):
        SRC.list_files(spark, str(tmp_path / "none"))


def test_series_matrix_later_line_wins_and_stop(spark, tmp_path):
    text = "\n".join([
        "!Sample_title\t\"Patient 12 a\"\t\"pt 7\"",
        "!Sample_geo_accession\t\"GSM1\"\t\"GSM2\"",
        "!Sample_relation\t\"SRA: x\"\t\"SRA: y\"",
        "!Sample_relation\t\"BioSample: https://h/biosample/SAMN1\"\t\"BioSample: https://h/biosample/SAMN2\"",
        "!Sample_characteristics_ch1\t\"ibd_disease: UC\"\t\"ibd_disease: CD\"",
        "!Sample_characteristics_ch1\t\"ibd_disease: Control\"\t\"age: 3\"",
        "!series_matrix_table_begin",
        "!Sample_title\t\"zzz\"\t\"zzz\"",
    ])
    p = tmp_path / "m.txt"
    p.write_text(text + "\n")
    rows = sorted(tuple(r) for r in SRC.parse_series_matrix(spark, str(p)).select(
        "Title", "GSM_ID", "BioSample", "Disease", "patient_id").collect())
    assert rows == [("Patient 12 a", "GSM1", "SAMN1", "Control", "12"), ("pt 7", "GSM2", "SAMN2", None, "7")]


def test_paths_for_unknown_type():
    assert SRC.paths_for("Tumor")[0] == "Tumor"
    with pytest.raises(ValueError):
        SRC.paths_for("blood")


def test_json_sink_and_table_cache(spark, tmp_path):
    df = spark.createDataFrame([("LR", 0.5)], "Model string, f1 double")
    SK.write_json(df, str(tmp_path / "m.json"))
    assert spark.read.json(str(tmp_path / "m.json")).first()["Model"] == "LR"
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    a = SK.cached_table(spark, str(tmp_path / "cache"), "k1", build)
    b = SK.cached_table(spark, str(tmp_path / "cache"), "k1", build)
    assert a.count() == b.count() == 5 and len(calls) == 1
    SK.cached_table(spark, str(tmp_path / "cache"), "k1", build, force=True)
    assert len(calls) == 2


def test_save_model(spark, tmp_path):
    from pyspark.ml.feature import StringIndexer, StringIndexerModel
    m = StringIndexer(inputCol="s", outputCol="i").fit(spark.createDataFrame([("a",), ("b",)], "s string"))
    SK.save_model(m, str(tmp_path / "model"))
    assert StringIndexerModel.load(str(tmp_path / "model")).labels == ["a", "b"]


def test_run_report_flags_empty_or_unreadable(spark):
    inputs = spark.createDataFrame([("a.parquet",), ("b.parquet",), ("c.parquet",)], "name string")
    reads = spark.createDataFrame([("a.parquet",), ("a.parquet",), ("b.parquet",)], "source_file string")
    matches = spark.createDataFrame([("a.parquet",)], "source_file string")
    rep = {r["source_file"]: (r["n_reads"], r["n_matches"], r["status"])
           for r in SK.run_report(inputs, reads, matches).collect()}
    assert rep == {"a.parquet": (2, 1, "analysed"), "b.parquet": (1, 0, "analysed"),
                   "c.parquet": (0, 0, "empty_or_unreadable")}


def test_scan_with_source_mixed_count_and_required_columns(spark, tmp_path):
    d = str(tmp_path / "reads")
    spark.createDataFrame([("ACGT", "r1", 3)], "sequence string, read_id string, count bigint") \
        .coalesce(1).write.mode("append").parquet(d)
    spark.createDataFrame([("TTTT", "r2")], "sequence string, read_id string").coalesce(1).write.mode("append").parquet(d)
    df = SRC.scan_with_source(spark, d, ["sequence", "read_id", "count"])
    rows = sorted((r["read_id"], r["count"]) for r in df.collect())
    assert rows == [("r1", 3), ("r2", None)]
    assert all(r["source_file"].endswith(".parquet") for r in df.collect())
    with pytest.raises(ValueError, match="available"):
        SRC.scan_with_source(spark, d, ["sequence", "missing_col"])


def test_read_run_table(spark, tmp_path):
    p = tmp_path / "runs.csv"
    p.write_text("Sample Name,Experiment,Run,Other\nGSM1,SRX1,SRR1,x\n")
    r = SRC.read_run_table(spark, str(p), "blood").collect()[0].asDict()
    assert r == {"GSM_ID_blood": "GSM1", "Experiment_blood": "SRX1", "Run_blood": "SRR1"}


def test_series_matrix_many_files_one_job(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"s{i}.txt").write_text(
            f"!Sample_title\t\"P{i}0 x\"\t\"P{i}1 y\"\n!Sample_geo_accession\t\"GSM{i}0\"\t\"GSM{i}1\"\n"
            "!series_matrix_table_begin\n")
    out = SRC.parse_series_matrix(spark, str(tmp_path / "s*.txt"))
    assert sorted(r["GSM_ID"] for r in out.collect()) == ["GSM00", "GSM01", "GSM10", "GSM11", "GSM20", "GSM21"]
    assert sorted(r["patient_id"] for r in out.collect())[:2] == ["00", "01"]


def test_publicness_keeps_the_first_row_in_file_order_without_windows(spark, tmp_path):
    for name, rows in (("b.csv", ["AAA,9", "CCC,8"]), ("a.csv", ["AAA,1.5", "GGG,", "AAA,2", "GGG,3", ",7", ",6"])):
        (tmp_path / name).write_text("\n".join(["CDR3_match,publicness_score", *rows]) + "\n")
    got = SRC.read_publicness(spark, str(tmp_path))
    assert {tuple(r) for r in got.collect()} == {("AAA", 1.5), ("GGG", None), (None, 7.0), ("CCC", 8.0)}
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_sorted_pieces_are_in_order_and_more_for_larger_tables(spark):
    from repflow.plans.partitioning import sorted_pieces

    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("o"))
    for piece in (100, 1 << 30):
        got = sorted_pieces(df, "o", piece)
        assert [r["o"] for r in got.collect()] == list(range(5000))
    assert sorted_pieces(df, "o", 100).rdd.getNumPartitions() == 400
