from pyspark.sql import functions as F

from repflow.operators import ml as ML


def test_ranks_of_large_ids_of_synthetic_rows(spark):
    ids = [0, 5, 3_399_999_999, 3_400_000_001, 10_255 * 1_000_003 + 1_000_000_007, 9_000_000_000_000_000_000]
    df = spark.createDataFrame([(i, 1, [float(k), 1.0]) for k, i in enumerate(ids)], "id long, label int, vec array<double>")
    got = {r["id"]: r["h"] for r in df.select("id", ML.hash_order(F.col("id")).alias("h")).collect()}
    assert got == {i: (i * 2654435761 + 42) % 4294967296 for i in ids}
    assert sorted(r["__rank"] for r in ML.rank_in_group(df, "label", "id").collect()) == list(range(6))


def test_smote_of_large_ids(spark):
    from repflow.operators import neighbors as NB

    rows = [(i * 1_000_003 + 1_000_000_000, int(i % 4 == 0), [float(i), float(i * i % 7)]) for i in range(5000, 5040)]
    got = NB.smote(spark.createDataFrame(rows, "id long, label int, vec array<double>"), "label", 3)
    assert got.where("label = 1").count() == 30
