import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from repflow.operators import ml as ML


def test_roc_auc_matches_pairwise_definition(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 20))) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = ML.roc_auc(df, "y", "s").first()["roc_auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_roc_auc_null_unless_binary(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "y int, s double")
    assert ML.roc_auc(df, "y", "s").first()["roc_auc"] is None


def test_distributed_rank_equals_window_rank(spark):
    df = spark.range(5000).select(F.col("id").alias("vid"), (F.col("id") % 3).alias("g"))
    r = ML.rank_in_group(df, "g", "vid", n_buckets=16)
    w = Window.partitionBy("g").orderBy(ML.hash_order(F.col("vid")), "vid")
    ref = df.withColumn("rk", F.row_number().over(w) - 1)
    j = r.join(ref, ["vid", "g"])
    assert j.where(F.col("__rank") != F.col("rk")).count() == 0


def test_split_and_resampling_proportions(spark):
    df = spark.range(1000).select(F.col("id").alias("vid"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))
    s = ML.stratified_split(df, "y", "vid").groupBy("y", "split").count().collect()
    d = {(r["y"], r["split"]): r["count"] for r in s}
    assert d[(1, "test")] == 20 and d[(0, "test")] == 180
    over = ML.oversample(df, "y", "vid").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in over} == {0: 900, 1: 900}
    under = ML.undersample(df, "y", "vid").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in under} == {0: 100, 1: 100}


def test_median_impute_drops_all_null(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (10.0, None)], "a double, b double")
    out = ML.median_impute(df, ["a", "b"])
    assert out.columns == ["a"]
    assert sorted(r["a"] for r in out.collect()) == [1.0, 3.0, 3.0, 10.0]


def test_feature_vectors_equal_wide_pivot(spark):
    from repflow.operators import repertoire as P

    long = spark.createDataFrame([("s1", "CA", 2.0), ("s1", "CB", 1.0), ("s2", "CB", 5.0), ("s3", "CC", 1.0)],
                                 "sample string, sequence string, value double")
    top = P.top_sequences(long, 2)                       # CB (2 samples), then CA
    vec = {r["sample"]: r["features"].toArray().tolist() for r in P.sparse_vectors(P.restrict_to(long, top), top).collect()}
    assert vec == {"s1": [1.0, 2.0], "s2": [5.0, 0.0]}
    wide = {r["sample"]: [r["CB"], r["CA"]] for r in P.pivot_matrix(P.restrict_to(long, top), ["CB", "CA"]).collect()}
    assert wide == vec


def test_models_have_the_settings_of_the_reference(spark):
    from repflow.operators import models as MD

    m = MD.classifiers(2)
    assert m["Random Forest"].getNumTrees() == 200 and m["Random Forest"].getMaxDepth() == 30
    assert (m["Gradient Boosting"].getMaxIter(), m["Gradient Boosting"].getStepSize()) == (300, 0.05)
    draws = {name: maps for name, (_, maps) in MD.searches(10).items()}
    assert {name: len(maps) for name, maps in draws.items()} == {"rf": 8, "xgb": 8, "lgb": 6}
    drawn = {(name, p.name): set() for name, maps in draws.items() for p in maps[0]}
    for name, maps in draws.items():
        for pm in maps:
            for p, v in pm.items():
                drawn[name, p.name].add(v)
    assert drawn["rf", "numTrees"] <= {200, 400, 600} and drawn["xgb", "maxIter"] <= {200, 400} and drawn["lgb", "maxIter"] <= {200, 400}


def test_search_reaches_the_boosters_of_one_versus_rest(spark):
    from repflow.operators import models as MD
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(float(i % 3), Vectors.dense([i % 3 + (i % 7) / 10, i % 5])) for i in range(60)], ["label", "features"])
    est, maps = MD.searches(3)["lgb"]
    pm = dict(maps[0]) | {p: 2 for p in maps[0] if p.name == "maxIter"}
    model = est.fit(df, pm)
    assert [m.getNumTrees for m in model.models] == [2, 2, 2]
    assert MD.soft_vote_models({"a": model, "b": model, "c": model}, df, 3).count() == 60


def test_resampling_has_every_variant(spark):
    from repflow.operators import models as MD
    from pyspark.ml.linalg import Vectors

    rows = [(i, int(i % 4 == 0), Vectors.dense([float(i), float(i * i % 17)])) for i in range(80)]
    got = MD.resampled(spark.createDataFrame(rows, ["doc_id", "toxic", "scaled"]), "toxic", "doc_id")
    n = {name: {r["toxic"]: r["count"] for r in df.groupBy("toxic").count().collect()} for name, df in got.items()}
    assert n == {"base": {0: 60, 1: 20}, "over": {0: 60, 1: 60}, "under": {0: 20, 1: 20}, "smote": {0: 60, 1: 60}, "weighted": {0: 60, 1: 20}}
