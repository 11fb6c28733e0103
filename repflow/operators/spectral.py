"""Principal components of a sparse matrix in coordinate form (MAT-11), never dense.

``(cell, gene, value)`` holds the stored entries; what is not stored is 0.  The gene means are
subtracted implicitly: with row vectors ``x`` and means ``mu``, one pass computes
``C B = (sum_x x (x B) - n mu (mu B)) / (n - 1)`` for a block ``B`` of a few vectors.

Blocks of the Krylov space ``B, C B, C^2 B, ...`` are made orthogonal against all earlier ones, and the
small projected problem gives the components.  Passes go on until the residual of every wanted component is below
``tol`` of the largest variance, or the space is full; a space that grows too wide is restarted from the best vectors.

Spark holds the matrix as one row of gene indices and values per cell, written once; every pass is one
job of vectorised kernels and a grouped sum by blocks of genes.  The driver and the tasks hold arrays of
genes x vectors (``max_genes`` bounds them), never anything by cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from repflow.plans.partitioning import materialize

GENE_BLOCK = 2048          # genes whose partial sums travel as one row
NNZ_STEP = 200_000         # entries multiplied at a time
MAX_GENES = 200_000


def indexed(coo: DataFrame, cell: str = "cell", gene: str = "gene", value: str = "value", max_genes: int = MAX_GENES):
    """``(rows, genes)``: per cell its gene numbers and values; the gene names in order.

    Null cells, genes and values are left out, values of one cell and gene are added up.
    """
    e = coo.select(F.col(cell).alias("cell"), F.col(gene).alias("gene"), F.col(value).cast("double").alias("value")).na.drop()
    names = [r[0] for r in e.select("gene").distinct().limit(max_genes + 1).collect()]      # bounded by max_genes
    if len(names) > max_genes:
        raise ValueError(f"more than {max_genes} genes; select variable genes first")
    names.sort()
    table = e.sparkSession.createDataFrame([(g, i) for i, g in enumerate(names)], "gene string, g int")
    one = e.groupBy("cell", "gene").agg(F.sum("value").alias("value")).join(F.broadcast(table), "gene")
    rows = one.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("g", "value"))).alias("x"))
    return materialize(rows.select("cell", F.transform("x", lambda x: x["g"]).alias("g"), F.transform("x", lambda x: x["value"]).alias("v"))), names


def _entries(b: pa.RecordBatch):
    """``(gene numbers, values, row bounds)`` of a batch."""
    g, v = b.column("g"), b.column("v")
    off = g.offsets.to_numpy().astype(np.int64)
    return g.flatten().to_numpy(), v.flatten().to_numpy(), off - off[0]


def _products(g: np.ndarray, v: np.ndarray, off: np.ndarray, m: np.ndarray) -> np.ndarray:
    """``x m`` for every sparse row ``x`` (rows x columns of ``m``)."""
    out = np.zeros((len(off) - 1, m.shape[1]))
    i = 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + NNZ_STEP, side="right")) - 1)
        s, e = off[i], off[j]
        if e > s:
            part, lens = v[s:e, None] * m[g[s:e]], np.diff(off[i:j + 1])
            full = np.flatnonzero(lens)
            out[i + full] = np.add.reduceat(part, off[i:j][full] - s, axis=0)
        i = j
    return out


def gene_sums(rows: DataFrame, n_genes: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sum and sum of squares per gene, and the number of stored cells."""
    s = rows.select(F.explode(F.arrays_zip("g", "v")).alias("x")).groupBy("x.g").agg(
        F.sum("x.v").alias("s"), F.sum(F.col("x.v") * F.col("x.v")).alias("q")).collect()          # one row per gene
    one, two = np.zeros(n_genes), np.zeros(n_genes)
    for r in s:
        one[r["g"]], two[r["g"]] = r["s"], r["q"]
    return one, two, rows.count()


def gram_times(rows: DataFrame, block: np.ndarray) -> np.ndarray:
    """``sum over cells of x (x block)``: one job; partial sums per task travel as rows of ``GENE_BLOCK`` genes."""
    n_genes, width = block.shape
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def partial(batches):
        m, total, used = shared.value, None, np.zeros(math.ceil(n_genes / GENE_BLOCK), dtype=bool)
        for b in batches:
            g, v, off = _entries(b)
            if not len(g):
                continue
            total = np.zeros((n_genes, width)) if total is None else total
            z, row = _products(g, v, off, m), np.repeat(np.arange(len(off) - 1), np.diff(off))
            order = np.argsort(g, kind="stable")
            for s in range(0, len(order), NNZ_STEP):
                o = order[s:s + NNZ_STEP]
                first = np.flatnonzero(np.concatenate([[True], g[o][1:] != g[o][:-1]]))
                total[g[o][first]] += np.add.reduceat(v[o, None] * z[row[o]], first, axis=0)
            used[np.unique(g // GENE_BLOCK)] = True
        at = np.flatnonzero(used)
        for k in at.tolist():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([total[k * GENE_BLOCK:(k + 1) * GENE_BLOCK].tobytes()], pa.binary())],
                                  names=["k", "part"])

    def summed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in b.column("part"):
                x = np.frombuffer(x.as_py())
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["k", "part"])

    parts = rows.mapInArrow(partial, "k int, part binary").groupBy("k").applyInArrow(summed, "k int, part binary")
    out = np.zeros((n_genes, width))
    for r in parts.collect():                                     # genes x width numbers
        got = np.frombuffer(r["part"]).reshape(-1, width)
        out[r["k"] * GENE_BLOCK:r["k"] * GENE_BLOCK + len(got)] = got
    shared.unpersist()
    return out


def _orthogonal(basis: np.ndarray, new: np.ndarray, seed: int) -> np.ndarray:
    """Orthonormal columns of ``new`` outside ``basis``; directions that lie inside become random ones."""
    new = new[:, :basis.shape[0] - basis.shape[1]]
    new = new / np.maximum(np.linalg.norm(new, axis=0), 1e-300)
    rng = np.random.default_rng(seed)
    for _ in range(3):
        new, r = np.linalg.qr(new - basis @ (basis.T @ new))
        lost = np.abs(np.diag(r)) < 1e-8
        new[:, lost] = rng.standard_normal((len(new), int(lost.sum())))
    return np.linalg.qr(new - basis @ (basis.T @ new))[0]


def principal_components(rows: DataFrame, n_genes: int, k: int, tol: float = 1e-9, max_width: int = 400, max_passes: int = 60,
                         seed: int = 42) -> dict:
    """``{components (genes x k), variances, total_variance, means, passes}`` of the centred rows.

    ``variances`` divide by ``n - 1``.  At most ``min(k, genes, cells - 1)`` components; signs make the largest loading
    of each positive.  Raises if the passes end before the components have settled.
    """
    one, two, n = gene_sums(rows, n_genes)
    k = max(0, min(k, n_genes, n - 1))
    mu = one / max(n, 1)
    total = float(max(0.0, (two - n * mu * mu).sum()) / max(n - 1, 1))
    if not k or total <= 0:
        return {"components": np.zeros((n_genes, 0)), "variances": np.zeros(0), "total_variance": total, "means": mu, "passes": 0}
    width = min(n_genes, k + 10)
    max_width = max(max_width, k + 3 * width)
    basis = image = np.zeros((n_genes, 0))
    q = _orthogonal(basis, np.random.default_rng(seed).standard_normal((n_genes, width)), seed)
    for done in range(1, max_passes + 1):
        image = np.hstack([image, (gram_times(rows, q) - n * np.outer(mu, mu @ q)) / (n - 1)])
        basis = np.hstack([basis, q])
        small = basis.T @ image
        w, u = np.linalg.eigh((small + small.T) / 2)
        w, u = w[::-1], u[:, ::-1]
        vectors, moved = basis @ u[:, :width], image @ u[:, :width]
        rest = moved - vectors * w[:width]
        if basis.shape[1] >= n_genes or np.linalg.norm(rest[:, :k], axis=0).max() <= tol * w[0]:
            break
        if basis.shape[1] + width > max_width:                    # start again from the best vectors
            basis, image = basis @ u[:, :k + width], image @ u[:, :k + width]
        q = _orthogonal(basis, rest, seed + done)
    else:
        raise RuntimeError(f"{k} components have not settled in {max_passes} passes; ask for fewer or a larger tolerance")
    vectors = vectors[:, :k]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    return {"components": vectors, "variances": np.maximum(w[:k], 0.0), "total_variance": total, "means": mu, "passes": done}


def scores(rows: DataFrame, model: dict, out: str = "pca") -> DataFrame:
    """``(cell, pca array<double>)``: every stored cell on the components."""
    shared = rows.sparkSession.sparkContext.broadcast((model["components"], model["means"] @ model["components"]))

    def to_scores(batches):
        m, shift = shared.value
        for b in batches:
            z = _products(*_entries(b), m) - shift
            offsets = pa.array(np.arange(0, z.size + 1, m.shape[1], dtype=np.int32) if m.shape[1] else np.zeros(len(z) + 1, np.int32))
            yield pa.record_batch([b.column("cell"), pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))], names=["cell", out])

    return rows.mapInArrow(to_scores, rows.select("cell").schema.add(out, ArrayType(DoubleType())))


def sparse_pca(coo: DataFrame, k: int = 50, cells: DataFrame | None = None, **kw) -> tuple[DataFrame, dict]:
    """MAT-11 on raw counts: ``(scores, model)`` of the centred matrix.

    ``cells`` lists every cell of the matrix; cells without an entry then count and get a score as well.
    """
    if cells is None:
        rows, genes = indexed(coo)
    else:
        every = cells.select("cell").where("cell IS NOT NULL").distinct()
        rows, genes = indexed(coo.join(every, "cell", "left_semi"))
        rows = materialize(every.join(rows, "cell", "left").select(
            "cell", F.coalesce("g", F.array().cast("array<int>")).alias("g"), F.coalesce("v", F.array().cast("array<double>")).alias("v")))
    model = principal_components(rows, len(genes), k, **kw)
    return scores(rows, model), model | {"genes": genes}


def scaled_pca(entries: DataFrame, zeros: DataFrame, cells: DataFrame, k: int = 50, **kw) -> tuple[DataFrame, dict]:
    """MAT-11 on a scaled matrix (MAT-10): stored entries plus one value per gene for all other cells.

    Centring takes the constant part away, so only each entry's difference from its gene's constant is kept.
    """
    base = zeros.select("gene", F.col("value").alias("__zero"))
    return sparse_pca(entries.join(F.broadcast(base), "gene").select("cell", "gene", (F.col("value") - F.col("__zero")).alias("value")), k, cells, **kw)
