from repflow.operators import relational as R


def test_first_containing_takes_earliest_id_by_order(spark):
    samples = spark.createDataFrame([("matched_SRR12.parquet",), ("x_SRR3_y",), ("none",)], "s string")
    ids = spark.createDataFrame([("SRR1", 1), ("SRR12", 0), ("SRR3", 5), (None, 2)], "run string, ord int")
    got = {r["s"]: r["matched_id"] for r in R.first_containing(samples, "s", ids, "run", "ord").collect()}
    assert got == {"matched_SRR12.parquet": "SRR12", "x_SRR3_y": "SRR3", "none": None}
    ids2 = spark.createDataFrame([("SRR1", 0), ("SRR12", 1)], "run string, ord int")
    got2 = {r["s"]: r["matched_id"] for r in R.first_containing(samples, "s", ids2, "run", "ord").collect()}
    assert got2["matched_SRR12.parquet"] == "SRR1"


def test_null_safe_full_outer_matches_pandas(spark):
    a = spark.createDataFrame([(None, "a0"), ("1", "a1")], "k string, v string")
    b = spark.createDataFrame([(None, "b0"), ("1", "b1")], "k string, v string")
    out = R.join_keys(a, b, "k", "full", null_safe=True, suffixes=("_l", "_r"))
    key = lambda t: tuple("" if x is None else x for x in t)
    assert sorted((tuple(r) for r in out.collect()), key=key) == [(None, "a0", "b0"), ("1", "a1", "b1")]
    assert out.columns == ["k", "v_l", "v_r"]
    plain = R.join_keys(a, b, "k", "full", null_safe=False)
    assert plain.count() == 3


def test_keep_first_and_membership(spark):
    df = spark.createDataFrame([("x", 2, "b"), ("x", 1, "a"), ("y", 3, "c")], "k string, o int, v string")
    assert sorted(tuple(r) for r in R.keep_first(df, "k", "o").collect()) == [("x", 1, "a"), ("y", 3, "c")]
    ref = spark.createDataFrame([("x", None), ("x", None)], "a string, b string")
    q = spark.createDataFrame([("x", None), ("x", "z")], "a string, b string")
    flags = sorted((r["b"] or "", r["is_in"]) for r in R.flag_membership(q, ref, ["a", "b"]).collect())
    assert flags == [("", True), ("z", False)]


def test_keep_first_of_numbers_sorts_no_rows(spark):
    df = spark.createDataFrame([("x", 2, 0.5, None), ("x", 1, None, 7), ("y", 3, 1.5, 2), (None, 4, 2.5, 1)], "k string, o int, v double, n bigint")
    got = R.keep_first(df, "k", "o")
    assert {tuple(r) for r in got.collect()} == {("x", 1, None, 7), ("y", 3, 1.5, 2), (None, 4, 2.5, 1)}
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
