import math

import numpy as np
import pytest

from repflow.operators import information as IN

SCHEMA = "id bigint, feature int, x double, y int"


def _psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, int(n)))


def _brute(rows, k=3):
    """The estimator by definition, per feature over all pairs (values already apart)."""
    out = {}
    for f in {r[1] for r in rows}:
        pts = [(i, x, y) for i, g, x, y in rows if g == f and x is not None and y is not None and math.isfinite(x)]
        size = {}
        for _, _, y in pts:
            size[y] = size.get(y, 0) + 1
        pts = [p for p in pts if size[p[2]] > 1]
        total = [0.0, 0.0, 0.0]
        for i, x, y in pts:
            near = sorted((abs(x - b), j, b) for j, b, c in pts if c == y and j != i)
            kc = min(k, size[y] - 1)
            r, _, at = near[kc - 1]
            lo, hi = (at if at <= x else x - r), (at if at >= x else x + r)
            m = sum(b == x if r == 0 else lo < b < hi for _, b, _ in pts)
            total = [total[0] + _psi(kc), total[1] + _psi(size[y]), total[2] + _psi(m)]
        out[f] = max(0.0, _psi(len(pts)) + (total[0] - total[1] - total[2]) / len(pts)) if pts else 0.0
    return out


def _got(df, **kw):
    return {r["feature"]: r["mi"] for r in IN.mutual_information_knn(df, **kw).collect()}


def test_digamma(spark):
    got = [r[0] for r in spark.range(1, 60).select(IN.digamma(__import__("pyspark").sql.functions.col("id"))).collect()]
    assert max(abs(a - _psi(n)) for n, a in enumerate(got, 1)) < 1e-13


@pytest.mark.parametrize("block", [65_536, 7])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(IN, "BLOCK_ROWS", block)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(160):
        y = int(rng.integers(0, 3))
        rows += [(i, 0, float(rng.normal(y)), y), (i, 1, float(rng.normal()), y), (i, 2, float(np.float32(rng.normal(3 * y))), y)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for k in (1, 3):
        got, want = _got(df, k=k, jitter=0), _brute(rows, k)
        assert all(abs(got[f] - want[f]) < 1e-9 for f in want) and got[2] > got[0] > got[1]


def test_jitter_keeps_clear_values_and_splits_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, 0, float(i % 2 if i % 5 else 0), i % 2) for i in range(200)] + [(i, 1, float(rng.normal()), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    apart = [tuple(r) for r in IN.jittered(df).select("id", "feature", "x", "y").collect()]
    assert max(abs(x - dict(((i, f), v) for i, f, v, _ in rows)[i, f]) for i, f, x, _ in apart) < 1e-9
    assert len({x for _, f, x, _ in apart if f == 0}) == 200
    got, want = _got(df), _brute(apart)
    assert all(abs(got[f] - want[f]) < 1e-9 for f in want) and got[0] > 0.3 > got[1]


def test_ties_small_classes_and_odd_values(spark):
    rows = [(i, 0, float(i // 4), i % 2) for i in range(24)] + [(100, 0, 1.0, 7)]              # ties, one class of one point
    rows += [(i, 1, float(i), 0 if i < 2 else 1) for i in range(6)]                            # a class of two points
    rows += [(i, 2, v, i) for i, v in enumerate((1.0, 2.0))]                                   # every class alone
    rows += [(i, 3, v, 1) for i, v in enumerate((None, float("nan"), float("inf"), 1.0, 1.0))] + [(9, 3, 1.0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got, want = _got(df, jitter=0), _brute(rows)
    assert set(got) == {0, 1, 2, 3} and all(abs(got[f] - want[f]) < 1e-9 for f in got)
    assert _got(df.limit(0)) == {}


def test_cohort_matrix_has_every_cell_without_a_join_of_cells(spark, monkeypatch):
    from repflow.plans import catalog_structure as cs

    seen = [("SRR1001", "CAAA", 3), ("SRR1001", "CAAT", 1), ("SRR1001", "CAAA", 1), ("SRR1002", "CAAT", 2), ("SRR1003", "CAAA", 9), ("SRR1004", "CAAT", 5)]
    monkeypatch.setattr(cs.fx, "matches", lambda s, d: spark.createDataFrame(seen, "sample string, CDR3_match string, count long"))
    monkeypatch.setattr(cs.fx, "metadata", lambda s, d: spark.createDataFrame(
        [("SRR1001", "active"), ("SRR1002", "inactive"), ("SRR1003", None), ("SRR1004", "active"), ("SRR1004", "inactive")], "Run string, target string"))
    monkeypatch.setattr(cs.P, "is_productive", lambda c: c.isNotNull())
    got = cs.cohort_matrix(spark, "")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan.split("Join", 1)[-1]                      # cells come after every join
    at = {(1001, "active"): {"CAAA": 0.8, "CAAT": 0.2}, (1002, "inactive"): {"CAAT": 1.0}, (1004, "active"): {"CAAT": 1.0}, (1004, "inactive"): {"CAAT": 1.0}}
    names = ["CAAT", "CAAA"]                                                        # by growing prevalence rank
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, j, v.get(n, 0.0), y) for (i, y), v in at.items() for j, n in enumerate(names))
