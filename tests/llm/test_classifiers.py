import numpy as np
from pyspark.sql import functions as F

from repflow.llm.langid import grams, identify
from repflow.llm.quality import model_tables, quality, quantiles, _log_p
from repflow.llm.toxicity import score_documents, segments
from .conftest import mod


def test_language_of_held_out_rows(mid):
    got = identify(mid, mod(3, 1)).join(mid.select("doc_id", "lang"), "doc_id").where("held_out")
    hit, n, lo, hi = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 3000 and hit > 0.99 and 0 <= lo <= hi <= 1


def test_language_ignores_label_source_and_id(small):
    a = {r.doc_id: (r.lang_pred, r.score) for r in identify(small, mod(3, 1)).collect()}
    hidden = small.withColumn("lang", F.when(mod(3, 1), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in identify(hidden, mod(3, 1)).collect()}


def test_language_of_odd_rows(odd_docs, no_docs):
    got = identify(odd_docs, mod(3, 1)).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if r.doc_id in (3, 4, 5, 10, 11):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 13)} <= {"en", "fr", "de"}
    assert identify(no_docs, mod(3, 1)).count() == 0
    assert {r.lang_pred for r in identify(odd_docs.withColumn("lang", F.lit(None).cast("string")), mod(3, 1)).collect()} == {"und"}


def test_grams_are_distinct_presences():
    b = np.frombuffer(b"AbAb", np.uint8)
    assert len(grams(b)) == 2 + 2 + 2 and len(grams(b[:0])) == 0 and len(grams(b[:1])) == 1


def _segments_brute(s):
    """All maximal segments by the recursive definition: the best segment, then left and right of it."""
    best = max(((sum(s[i:j]), -(j - i), -i) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0, 0, 0))
    if best[0] <= 1e-12:
        return []
    i = -best[2]
    j = i - best[1]
    return [(x, y, v) for x, y, v in _segments_brute(s[:i])] + [(i, j, best[0])] + [(x + j, y + j, v) for x, y, v in _segments_brute(s[j:])]


def test_segments_match_the_definition():
    rng = np.random.default_rng(4)
    for _ in range(300):
        s = np.round(rng.normal(-0.3, 2, rng.integers(0, 14)), 2)
        got, want = segments(s), _segments_brute(s.tolist())
        assert np.allclose([v for _, _, v in got], [v for _, _, v in want])
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]


def test_segments_of_long_texts_take_linear_time():
    import time

    rng = np.random.default_rng(6)
    for scores in (np.where(rng.random(160_000) < 0.3, 1.0, -0.7), np.where(np.arange(160_000) % 2 == 0, 1.0, -1.5),
                   np.where(np.arange(160_000) % 2 == 0, 1.5, -1.0)):
        began = time.process_time()
        got = segments(scores)
        assert time.process_time() - began < 0.5 and all(a[1] <= b[0] for a, b in zip(got, got[1:]))


def test_toxic_held_out_rows(mid, labels):
    got = score_documents(mid, labels, mod(5, 0)).join(labels, "doc_id").where("held_out").toPandas()
    rank = got.score.rank()
    n1, n0 = (got.toxic == 1).sum(), (got.toxic == 0).sum()
    assert (rank[got.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.93
    assert ((got.predicted == 1) & (got.toxic == 0)).sum() <= 0.02 * n0
    assert ((got.score >= 0.5).astype(int) == got.predicted).all()


def test_toxicity_of_odd_rows_and_single_classes(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1), (2, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    for lab in (none, one):
        got = score_documents(odd_docs, lab, mod(5, 0)).collect()
        assert len(got) == odd_docs.count() and len({r.score for r in got}) == 1 and all(0 <= r.score <= 1 for r in got)
    assert score_documents(no_docs, none, mod(5, 0)).count() == 0


def test_kneser_ney_is_a_distribution(spark):
    df = spark.createDataFrame([("abracadabra abra cadabra",), ("banana bandana",)], "text string")
    tables = model_tables(df, 3)
    for ctx in (b"ab", b"an", b"zz", b"b\x00"):
        g = np.array([s | ctx[1] << 8 | ctx[0] << 16 for s in range(256)], np.uint64)
        assert abs(np.exp(_log_p(g, tables)).sum() - 1) < 1e-9


def test_quality_keeps_clean_and_drops_junk(mid, labels):
    got = quality(mid, labels.where("quality = 1").select("doc_id")).join(labels, "doc_id")
    kept = {r.quality: r.kept for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.2


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    trusted = spark.createDataFrame([(1,), (6,), (None,)], "doc_id bigint")
    got = quality(odd_docs, trusted).collect()
    assert len(got) == odd_docs.count() and not any(r.kept for r in got if r.n_bytes == 0)
    none = quality(odd_docs, trusted.limit(0)).collect()
    assert all(r.kept == (r.n_bytes > 0) for r in none)
    assert quality(no_docs, trusted).count() == 0


def test_all_trusted_text_counts_however_long(spark):
    # 80 MB of long texts, and 400 short ones of a rare language that a sample of fixed size would lose
    long = spark.range(200).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("the long text number "), "id", F.lit(" goes on and on. ")), 10_000).alias("text"), F.lit("en").alias("lang"))
    rare = spark.range(1000, 1400).select(F.col("id").alias("doc_id"), F.concat(F.lit("žluťoučký kůň úpěl ďábelské ódy "), F.sha2(F.col("id").cast("string"), 256)).alias("text"), F.lit("cs").alias("lang"))
    docs = long.unionByName(rare)
    got = quality(docs, docs.select("doc_id"), min_texts=30).groupBy("lang").agg(F.min("threshold").alias("t"), F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    limit, kept = {r.lang: r.t for r in got}, {r.lang: r.kept for r in got}
    assert limit["cs"] != limit["en"] and kept["cs"] > 0.95 and kept["en"] > 0.95


def test_quality_is_the_same_from_shared_and_joined_model(small, odd_docs, labels):
    for df, trusted in ((small, labels.where("quality = 1").select("doc_id")), (odd_docs, odd_docs.select("doc_id"))):
        rows = [sorted((r.doc_id or -1, r.lang or "", r.n_bytes, r.kept, round(r.perplexity or 0, 6), round(r.threshold, 6)) for r in quality(df, trusted, min_texts=5, **kw).collect())
                for kw in ({}, {"max_shared": 0, "chunk_bytes": 40_000})]
        assert rows[0] == rows[1] and len(rows[0]) == df.count()


def test_quantiles_are_exact(spark):
    rnd = np.random.default_rng(5)
    rows = [(k, float(v)) for k, n in (("a", 1), ("b", 2), ("c", 400), ("d", 1001)) for v in np.round(rnd.normal(2, 0.3, n), 2 if k == "c" else 9)]
    df = spark.createDataFrame(rows, "key string, rate double")
    for q in (0.0, 0.5, 0.995, 1.0):
        for r in quantiles(df, q).collect():
            own = [v for k, v in rows if k == r.key]
            assert r.n == len(own) and abs(r.limit - np.quantile(own, q)) < 1e-12
