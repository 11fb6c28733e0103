"""Guards that stop a run, defined values for empty and odd input, and smaller readers and writers."""

import pytest
from pyspark.sql import functions as F

from repflow.operators import matrix as MX
from repflow.operators import ml as ML
from repflow.operators import relational as R
from repflow.operators import repertoire as P
from repflow.operators import singlecell as SC
from repflow.sinks import files as SK
from repflow.sources import files as SF


def test_target_guards_raise(spark):
    md = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r3", None)], "Run string, y string")
    assert R.require_target(md, "y").first()["few_classes"]
    with pytest.raises(ValueError):
        R.require_target(md, "nope")
    with pytest.raises(ValueError):
        R.require_target(md.withColumn("y", F.when(F.col("Run") == "r1", F.col("y"))), "y")
    with pytest.raises(ValueError):
        R.require_target(md.limit(0), "y")
    assert R.drop_null_target(md, "y", required=True).count() == 2
    with pytest.raises(ValueError):
        R.drop_null_target(md.where("y IS NULL"), "y", required=True)


def test_align_metadata_raises_and_fans_out(spark):
    md = spark.createDataFrame([("r2", "b"), ("r1", "a"), ("r1", "c")], "Run string, y string")
    samples = spark.createDataFrame([("r2",), ("r1",), ("r1",)], "sample string")
    assert [(r["sample"], r["y"]) for r in R.align_metadata(samples, md).orderBy("sample", "y").collect()] == [("r1", "a"), ("r1", "c"), ("r2", "b")]
    with pytest.raises(ValueError, match="r9"):
        R.align_metadata(spark.createDataFrame([("r9",)], "sample string"), md)


def test_constant_features_go(spark):
    long = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (1, "b", 3.0), (2, "b", 3.0), (1, "c", None), (2, "c", float("nan"))],
                                 "id int, feature string, x double")
    assert {r["feature"] for r in ML.drop_constant_features(long).collect()} == {"a"}


def test_binary_metrics_by_hand(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4 + [(None, 1), (1, None)]
    m = ML.binary_metrics(spark.createDataFrame(rows, "label int, prediction int")).first()
    assert (m["precision"], m["recall"]) == (3 / 5, 3 / 5) and m["accuracy"] == 7 / 11
    assert m["balanced_accuracy"] == pytest.approx((3 / 5 + 4 / 6) / 2) and m["f1"] == pytest.approx(0.6)
    none = ML.binary_metrics(spark.createDataFrame([], "label int, prediction int")).first()
    assert none["accuracy"] is None and none["f1"] == 0.0


def test_auc_of_empty_and_null_scores(spark):
    df = spark.createDataFrame([(1, 2.0), (0, 1.0), (1, None)], "y int, s double")
    assert ML.roc_auc(df.limit(0), "y", "s").first()[0] is None
    assert ML.roc_auc(df, "y", "s").first()[0] == 1.0 and ML.roc_auc(df.where("y = 1"), "y", "s").first()[0] is None


def test_depth_zero_has_value_zero(spark):
    long = spark.createDataFrame([("a", "CA", 0), ("a", "CB", 0), ("b", "CA", 3), ("b", "CB", 1), (None, "CA", 2)], "sample string, sequence string, count bigint")
    got = {(r["sample"], r["sequence"]): r["value"] for r in P.normalise_by_depth(long).collect()}
    assert got == {("a", "CA"): 0.0, ("a", "CB"): 0.0, ("b", "CA"): 0.75, ("b", "CB"): 0.25, (None, "CA"): 1.0}


def test_feature_column_rules(spark):
    t = spark.createDataFrame([("x", 1, 2.0, True, [1.0], True)], "s string, i int, d double, label boolean, v array<double>, b boolean")
    assert SC.feature_columns(t, "v1") == ["i", "d"] and SC.feature_columns(t, "v2") == ["i", "d", "v", "b"]
    with pytest.raises(ValueError):
        SC.feature_columns(t, "v3")


def test_expression_vectors_join(spark):
    expr = spark.createDataFrame([("BC1-1", "g2", 2.0), ("BC1-1", "g1", 1.0), ("BC1-1", "g2", 3.0), ("BC2-1", None, 1.0)], "barcode string, gene string, value double")
    t = spark.createDataFrame([("BC1", 1), ("BC2", 2), (None, 3)], "CB string, n int")
    got = {r["n"]: (r["genes"], r["values"]) for r in SC.with_expression(t, expr).collect()}
    assert got == {1: (["g1", "g2"], [1.0, 5.0]), 2: (None, None), 3: (None, None)}


def test_typing_without_known_genes_and_constant_cells(spark):
    coo = spark.createDataFrame([("a", "g1", 1.0), ("a", "g2", 1.0), ("b", "zz", 5.0), ("c", "g1", -2.0), ("c", "g3", 4.0)], "cell string, gene string, value double")
    w = spark.createDataFrame([("g1", "T", 1.0), ("g2", "B", 1.0)], "gene string, cell_type string, weight double")
    i = spark.createDataFrame([("T", 0.0)], "cell_type string, intercept double")
    got = {r["cell"]: (r["predicted_labels"], r["prob"]) for r in MX.type_scores(coo, w, i).collect()}
    assert got["a"][0] == "B" and got["c"] == ("B", 0.5) and "b" not in got
    ref = spark.createDataFrame([("r1", "T", "g1", 1.0), ("r1", "T", "g2", 2.0), ("r1", "T", "g3", 3.0), ("r2", "B", "g1", 3.0), ("r2", "B", "g2", 2.0), ("r2", "B", "g3", 1.0)],
                                "ref_id string, label string, gene string, value double")
    got = {r["cell"]: (r["label"], r["score"]) for r in MX.spearman_typing(coo, ref).collect()}
    assert got["c"] == ("T", pytest.approx(1.0)) and got["a"][0] == "B" and "b" not in got
    flat = spark.createDataFrame([("d", g, 2.0) for g in ("g1", "g2", "g3")], "cell string, gene string, value double")
    assert MX.spearman_typing(flat, ref).first()["score"] is None


def test_scan_by_name(spark, tmp_path):
    for name, rows in (("SRX12_vdj_filtered_contig_annotations.csv", "barcode,cdr3\nB1,CA\n"), ("SRX7_vdj_filtered_contig_annotations.csv", "barcode,cdr3\nB2,CB\n"),
                       ("noid_vdj_filtered_contig_annotations.csv", "barcode,cdr3\nB3,CC\n"), ("other.csv", "x\n1\n")):
        (tmp_path / name).write_text(rows)
    got = SF.scan_by_name(spark, str(tmp_path), "*_vdj_filtered_contig_annotations.csv", ["barcode", "cdr3"], fmt="csv")
    assert {(r["barcode"], r["srx"]) for r in got.collect()} == {("B1", "SRX12"), ("B2", "SRX7"), ("B3", None)}
    with pytest.raises(ValueError):
        SF.scan_by_name(spark, str(tmp_path), "*.parquet")
    with pytest.raises(ValueError):
        SF.scan_by_name(spark, str(tmp_path), "*_annotations.csv", ["nope"], fmt="csv")


def test_matrix_market_in_one_or_many_files(spark, tmp_path):
    (tmp_path / "barcodes.tsv").write_text("AA-1\nCC-1\n")
    (tmp_path / "features.tsv").write_text("E1\tg1\tx\nE2\tg2\tx\n")
    (tmp_path / "matrix.mtx").write_text("%%MatrixMarket matrix\n%note\n2 2 3\n1 1 5\n2 2 7\n1 2 1\n")
    want = {("AA", "g1", 5.0), ("CC", "g2", 7.0), ("CC", "g1", 1.0)}
    assert {tuple(r) for r in SF.read_10x_mtx(spark, str(tmp_path)).collect()} == want
    (tmp_path / "matrix.mtx").unlink()
    (tmp_path / "matrix.mtx").mkdir()
    (tmp_path / "matrix.mtx" / "part-0").write_text("%%MatrixMarket matrix\n%note\n2 2 3\n1 1 5\n")
    (tmp_path / "matrix.mtx" / "part-1").write_text("2 2 7\n1 2 1\n")
    assert {tuple(r) for r in SF.read_10x_mtx(spark, str(tmp_path)).collect()} == want


def test_fingerprint_parts(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for n in "ab":
        (tmp_path / "d" / n).write_text(n)
    (tmp_path / "m.csv").write_text("x")
    key = lambda **kw: SK.input_fingerprint(spark, str(tmp_path / "d"), **kw)
    plain = key()
    assert len(plain) == 12 and key() == plain
    keys = {plain, key(extra="e"), key(config={"k": 5}), key(config={"k": 6}), key(metadata_path=str(tmp_path / "m.csv"))}
    assert len(keys) == 5 and key(config={"a": 1, "b": 2}) == key(config={"b": 2, "a": 1})
    (tmp_path / "d" / "b").write_text("longer")
    assert key() != plain


def test_saved_run_is_read_back(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
    from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler

    df = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(
        spark.createDataFrame([(float(i % 2), float(i), float(i * i % 7)) for i in range(20)], "label double, a double, b double"))
    scaler = StandardScaler(inputCol="f", outputCol="z").fit(df)
    model = LogisticRegression(featuresCol="z", maxIter=3).fit(scaler.transform(df))
    SK.save_run(str(tmp_path / "run"), model, ["b", "a"], scaler)
    again, selected, scaler2 = SK.load_run(str(tmp_path / "run"), LogisticRegressionModel, StandardScalerModel)
    assert selected == ["b", "a"] and scaler2.std == scaler.std
    want = [r["prediction"] for r in model.transform(scaler.transform(df)).collect()]
    assert [r["prediction"] for r in again.transform(scaler2.transform(df)).collect()] == want
