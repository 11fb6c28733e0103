import numpy as np
import pytest
from pyspark.sql import functions as F

from repflow.operators import matrix as M
from repflow.operators import spectral as SP

SCHEMA = "cell string, gene string, value double"


def _random(rng, cells, genes, share=0.15):
    hit = np.argwhere(rng.random((cells, genes)) < share)
    value = rng.gamma(1.0, 3.0, len(hit)) * (1 + hit[:, 1] % 5)
    return [(f"c{i}", f"g{j:03d}", float(v)) for (i, j), v in zip(hit, value)]


def _dense(rows, cells, genes):
    x = np.zeros((len(cells), len(genes)))
    ci, gi = {c: i for i, c in enumerate(cells)}, {g: i for i, g in enumerate(genes)}
    for c, g, v in rows:
        x[ci[c], gi[g]] += v
    return x


def _compare(got, model, x, cells, k):
    xc = x - x.mean(0)
    _, s, vt = np.linalg.svd(xc, full_matrices=False)
    want = s[:k] ** 2 / (len(x) - 1)
    assert np.abs(model["variances"] - want).max() <= 1e-6 * want[0]
    assert model["total_variance"] == pytest.approx((s ** 2).sum() / (len(x) - 1), rel=1e-9)
    table = {r["cell"]: r["pca"] for r in got.collect()}
    z = np.array([table[c] for c in cells])
    assert z.shape == (len(cells), k)
    assert np.abs(z ** 2 - (xc @ vt[:k].T) ** 2).max() <= 1e-6 * (xc @ vt[:k].T).__abs__().max() ** 2


def test_raw_counts_equal_dense(spark):
    rng = np.random.default_rng(3)
    rows = _random(rng, 150, 90)
    df = spark.createDataFrame(rows + [("c0", None, 1.0), (None, "g001", 1.0), ("c0", "g001", None)], SCHEMA).repartition(5)
    got, model = SP.sparse_pca(df, 12)
    cells, genes = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    assert model["genes"] == genes
    _compare(got, model, _dense(rows, cells, genes), cells, 12)


def test_restarts_give_the_same(spark, monkeypatch):
    """A space too narrow for all genes is started again from its best vectors; blocks of few genes, small steps."""
    monkeypatch.setattr(SP, "GENE_BLOCK", 64)
    rng = np.random.default_rng(4)
    base = rng.standard_normal((120, 6)) * [40, 30, 22, 16, 12, 9]
    x = np.maximum(0, base @ rng.standard_normal((6, 300)) + rng.standard_normal((120, 300)))
    rows = [(f"c{i:03d}", f"g{j:03d}", float(x[i, j])) for i, j in np.argwhere(x > 4)]
    x = np.where(x > 4, x, 0)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    table, genes = SP.indexed(df)
    model = SP.principal_components(table, len(genes), 4, max_width=0, max_passes=200)
    cells = sorted({r[0] for r in rows})
    _compare(SP.scores(table, model), model, _dense(rows, cells, genes), cells, 4)
    with pytest.raises(RuntimeError):
        SP.principal_components(table, len(genes), 4, max_passes=1)


def test_scaled_matrix_equals_dense(spark):
    rng = np.random.default_rng(5)
    rows = _random(rng, 60, 40, 0.3)
    coo = spark.createDataFrame(rows, SCHEMA)
    extra = spark.createDataFrame([("lonely", "x", 0.0)], SCHEMA)          # a cell without any of the genes
    cells = coo.unionByName(extra)
    entries, zeros = M.scale(coo, cells=cells)
    got, model = SP.scaled_pca(entries, zeros, cells, 8)
    names, genes = sorted({r[0] for r in rows} | {"lonely"}), sorted({r[1] for r in rows})
    x = _dense(rows, names, genes)
    sd = x.std(0, ddof=1)
    z = np.clip((x - x.mean(0)) / np.where(sd == 0, 1, sd), -10, 10)
    _compare(got, model, z, names, 8)


def test_few_cells_constant_and_empty_matrices(spark):
    rows = [("a", "g", 1.0), ("b", "g", 2.0), ("b", "h", 1.0)]
    got, model = SP.sparse_pca(spark.createDataFrame(rows, SCHEMA), 50)
    assert model["components"].shape == (2, 1) and model["variances"][0] == pytest.approx(1.0)
    same = spark.createDataFrame([("a", "g", 3.0), ("b", "g", 3.0)], SCHEMA)
    got, model = SP.sparse_pca(same, 5)
    assert model["total_variance"] == 0 and [r["pca"] for r in got.collect()] == [[], []]
    got, model = SP.sparse_pca(same.limit(0), 5)
    assert got.collect() == [] and len(model["variances"]) == 0
    with pytest.raises(ValueError):
        SP.indexed(spark.range(5).select(F.lit("c").alias("cell"), F.col("id").cast("string").alias("gene"), F.lit(1.0).alias("value")), max_genes=3)
