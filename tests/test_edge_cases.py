"""Ordinary edge input under ANSI arithmetic, and scans of broken files."""

import math
import os

import pytest

from repflow.operators import matrix as MX
from repflow.operators import ml as ML
from repflow.operators import sequence as seq
from repflow.sources import files as SF


def test_anova_of_constant_and_perfect_features(spark):
    long = spark.createDataFrame([(i, f, float(v)) for i in range(4) for f, v in ((0, 1), (1, i // 2), (2, i))],
                                 "id int, feature int, x double")
    lab = spark.createDataFrame([(i, i // 2) for i in range(4)], "id int, y int")
    f = {r["feature"]: r["f"] for r in ML.anova_f(long, lab, "id", "y").collect()}
    assert math.isnan(f[0]) and f[1] == math.inf and abs(f[2] - 8.0) < 1e-9


def test_positive_weight_without_positives(spark):
    assert ML.positive_weight(spark.createDataFrame([(0,), (0,)], "y int"), "y").first()[0] is None


def test_cells_of_total_zero(spark):
    coo = spark.createDataFrame([("a", "g", 0.0), ("b", "g", 3.0), ("b", "MT-1", 1.0)], "cell string, gene string, value double")
    qc = {r["cell"]: r["pct_counts_mt"] for r in MX.cell_qc(coo).collect()}
    assert math.isnan(qc["a"]) and qc["b"] == 25.0
    assert {r["cell"] for r in MX.filter_mito(coo, 30.0).collect()} == {"b"}
    assert sorted((r["cell"], r["value"]) for r in MX.normalise_total(coo, 8.0).collect()) == [("a", 0.0), ("b", 2.0), ("b", 6.0)]


def test_variable_genes_without_spread(spark):
    coo = spark.createDataFrame([("a", g, 1.0) for g in "xyz"], "cell string, gene string, value double")
    assert [r["highly_variable"] for r in MX.highly_variable_genes(coo).collect()] == [False] * 3


def test_frames_start_no_job_while_the_plan_is_built(spark):
    reads = spark.range(100).selectExpr("'ATGTGG' AS sequence", "id AS read_id").groupBy("sequence").agg({"read_id": "max"})
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    seq.frames(reads, "sequence")
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_truncated_file_is_not_read_silently(spark, tmp_path):
    d = str(tmp_path / "in")
    spark.createDataFrame([("ATG", f"r{i}") for i in range(50)], "sequence string, read_id string").coalesce(1).write.parquet(d)
    name = next(x for x in os.listdir(d) if x.startswith("part-"))
    with open(f"{d}/broken.parquet", "wb") as f:
        f.write(open(f"{d}/{name}", "rb").read()[:-40])
    with pytest.raises(Exception):
        SF.scan_with_source(spark, d, ["sequence", "read_id"], merge_schema=False).count()
    counts = {r["source_file"]: r["footer_rows"] for r in SF.row_counts(spark, d).collect()}
    assert counts == {name: 50}
