import numpy as np
import pytest
from pyspark.sql import functions as F

from repflow.operators import ml as ML
from repflow.operators import relational as R
from repflow.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)


def _check(df, rows, **kw):
    got = {r["g"]: [r[f"q{i}"] for i in range(len(PROBS))] for r in exact_quantiles(df, ["g"], "v", PROBS, **kw).collect()}
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, v in groups.items():
        v = [x for x in v if x is not None and x == x]
        if not v:
            assert got[g] == [None] * len(PROBS)
            continue
        assert got[g] == pytest.approx(np.quantile(v, PROBS).tolist(), rel=1e-12, abs=1e-12), g


@pytest.mark.parametrize("bins, passes", [(1024, 2), (3, 1), (3, 4), (8, 0)])
def test_equals_numpy(spark, bins, passes):
    rng = np.random.default_rng(bins + passes)
    rows = [("hot", float(x)) for x in rng.lognormal(0, 3, 3000)] + [("ties", float(x)) for x in rng.integers(0, 4, 500)]
    rows += [("one", 7.5), (None, 1.0), (None, 2.0), ("none", None), ("none", float("nan")), ("const", 3.0), ("const", 3.0)]
    rows += [("wide", s * 10.0 ** e) for e in range(-300, 300, 7) for s in (-1, 1)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    _check(df, rows, bins=bins, passes=passes)


def test_without_groups_and_empty(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert tuple(exact_quantiles(df, [], "v", (0.25, 0.5)).first()) == (25.0, 50.0)
    assert tuple(exact_quantiles(df.limit(0), [], "v", (0.5,), ["m"]).first()) == (None,)
    assert exact_quantiles(df.limit(0).withColumn("g", F.lit(1)), ["g"], "v", (0.5,)).collect() == []


def test_a_third_of_all_rows_in_one_group_is_spread(spark):
    """No task of the ordering step holds more than a share of the hot group's values."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500)).alias("g"),
                                    F.xxhash64("id").cast("double").alias("v"))
    from repflow.operators.ranks import running_before

    r = running_before(df, ["g"], ["v"])
    w = df.groupBy("g").count().where("g = 'hot'").first()["count"]
    assert r.where("g = 'hot'").agg(F.min("before"), F.max("before"), F.count_distinct("before")).first() == (0, w - 1, w)
    per = r.where("g = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(per) > 1
    q = exact_quantiles(df, ["g"], "v", (0.5,)).where("g = 'hot'").first()["q0"]
    assert q == pytest.approx(np.quantile([x[0] for x in df.where("g = 'hot'").select("v").collect()], 0.5), rel=1e-12)


def test_users_of_the_quantiles(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 2.0, 5.0), ("a", 10.0, 6.0), ("b", None, 7.0)], "g string, v double, w double")
    got = {r["g"]: (r["count"], r["q25"], r["q50"], r["q75"]) for r in R.describe_exact(df, "v", ["g"]).collect()}
    assert got == {"a": (3, 1.5, 2.0, 6.0), "b": (0, None, None, None)}
    assert R.describe_exact(df, "v").first()["q50"] == 2.0
    filled = ML.median_impute(df, ["v", "w"])
    assert sorted((r["v"], r["w"]) for r in filled.collect()) == [(1.0, 6.0), (2.0, 5.0), (2.0, 7.0), (10.0, 6.0)]


def test_offsets_of_partitions_join_without_moving_the_rows(spark):
    from repflow.operators.ranks import running_before

    df = spark.range(2_000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("v"), F.lit("x").alias("wide"))
    df = df.unionByName(spark.range(1).select(F.lit(None).cast("long").alias("g"), F.lit(1).cast("long").alias("v"), F.lit("n").alias("wide")))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = running_before(df, ["g"], ["v"], keep=["v"])
        plan = r._jdf.queryExecution().executedPlan().toString()
        rows = sorted(tuple(x) for x in r.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "SortMergeJoin" not in plan and r.columns == ["g", "v", "before"]
    want = [(g, v, i) for g in range(3) for i, v in enumerate(sorted(x["v"] for x in df.where(F.col("g") == g).collect()))]
    assert rows == want
