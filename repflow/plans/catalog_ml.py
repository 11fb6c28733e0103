"""Registered queries: ML features, resampling and evaluation (ML-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from repflow.operators import ml as ML
from repflow.plans import fixtures as fx
from repflow.plans.oracle import CTES, with_ctes
from repflow.plans.registry import r6, register

CTES.update({
    "emb_long": ((), """SELECT vec_id, label, unnest(range(0, len(embedding))) AS feature,
                               CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings"""),
    "emb_split": ((), """
        SELECT vec_id, label, CASE WHEN rn <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM (
          SELECT vec_id, label, count(*) OVER (PARTITION BY label) AS n,
                 row_number() OVER (PARTITION BY label ORDER BY (vec_id * 2654435761 + 42) % 4294967296, vec_id) AS rn
          FROM embeddings)"""),
    "emb_ranked": ((), """
        SELECT vec_id, label, count(*) OVER (PARTITION BY label) AS n,
               row_number() OVER (PARTITION BY label ORDER BY (vec_id * 2654435761 + 42) % 4294967296, vec_id) - 1 AS rk
        FROM embeddings"""),
    "doc_feats": ((), """
        SELECT l.doc_id, l.quality, l.toxic,
               CASE WHEN l.doc_id % 7 = 0 THEN NULL ELSE CAST(d.n_chars AS DOUBLE) END AS f_chars,
               CASE WHEN l.doc_id % 5 = 0 THEN NULL
                    ELSE CAST(length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS DOUBLE) END AS f_lines,
               CAST(NULL AS DOUBLE) AS f_empty
        FROM labels l JOIN documents d ON d.doc_id = l.doc_id"""),
    "preds": ((), """SELECT vec_id, label,
                            CAST((list_position(embedding, list_max(embedding)) - 1) % 10 AS INTEGER) AS prediction
                     FROM embeddings"""),
})


def _emb(spark, sf):
    return fx.table(spark, sf, "embeddings")


def _emb_long(spark, sf):
    e = _emb(spark, sf)
    return ML.long_features(e, "vec_id", "embedding").join(e.select("vec_id", "label"), "vec_id")


def _doc_feats(spark, sf):
    lab = fx.table(spark, sf, "labels")
    d = fx.table(spark, sf, "documents").select("doc_id", "n_chars", "text")
    j = lab.join(d, "doc_id")
    nl = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    return j.select("doc_id", "quality", "toxic",
                    F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("n_chars").cast("double")).alias("f_chars"),
                    F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(nl.cast("double")).alias("f_lines"),
                    F.lit(None).cast("double").alias("f_empty"))


def _preds(spark, sf):
    e = _emb(spark, sf)
    best = F.array_position("embedding", F.array_max("embedding")) - 1           # of the whole vector
    return e.select("vec_id", "label", (best % 10).cast("int").alias("prediction"))


@register("label_encoding", "ML-1", with_ctes("""
    SELECT ord, Disease, CAST(dense_rank() OVER (ORDER BY Disease) - 1 AS DOUBLE) AS Disease_idx
    FROM metadata WHERE Disease IS NOT NULL""", "metadata"))
def q_label_encoding(spark, sf):
    md = fx.metadata(spark, sf).where(F.col("Disease").isNotNull())
    return ML.label_encode(md, "Disease").select("ord", "Disease", "Disease_idx")


@register("median_impute", "ML-2", with_ctes("""
    SELECT doc_id, coalesce(f_chars, (SELECT quantile_cont(f_chars, 0.5) FROM doc_feats)) AS f_chars,
           coalesce(f_lines, (SELECT quantile_cont(f_lines, 0.5) FROM doc_feats)) AS f_lines
    FROM doc_feats""", "doc_feats"))
def q_median_impute(spark, sf):
    f = _doc_feats(spark, sf)
    return ML.median_impute(f, ["f_chars", "f_lines", "f_empty"]).select("doc_id", "f_chars", "f_lines")


@register("variance_filter", "ML-3", with_ctes("""
    SELECT feature, round(var_pop(x), 6) AS variance, var_pop(x) > 0 AS kept FROM emb_long GROUP BY 1""",
    "emb_long"))
def q_variance(spark, sf):
    v = ML.feature_variance(_emb_long(spark, sf))
    return v.select("feature", r6("variance").alias("variance"), "kept")


@register("stratified_split", "ML-7", with_ctes("SELECT vec_id, label, split FROM emb_split", "emb_split"))
def q_split(spark, sf):
    return ML.stratified_split(_emb(spark, sf), "label", "vec_id").select("vec_id", "label", "split")


@register("standardise_train_test", "ML-8", with_ctes("""
    SELECT l.vec_id, l.feature, s.split,
           round((l.x - st.m) / CASE WHEN st.sd = 0 THEN 1 ELSE st.sd END, 6) AS z
    FROM emb_long l JOIN emb_split s ON s.vec_id = l.vec_id
    JOIN (SELECT feature, avg(x) AS m, stddev_pop(x) AS sd FROM emb_long l2 JOIN emb_split s2 ON s2.vec_id = l2.vec_id
          WHERE s2.split = 'train' GROUP BY 1) st ON st.feature = l.feature""", "emb_long", "emb_split"))
def q_standardise(spark, sf):
    split = ML.stratified_split(_emb(spark, sf), "label", "vec_id").select("vec_id", "split")
    z = ML.standardise(_emb_long(spark, sf).join(split, "vec_id"))
    return z.select("vec_id", "feature", "split", r6("z").alias("z"))


@register("class_weights", "ML-12", with_ctes("""
    SELECT label, count(*) AS n_c, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
    FROM embeddings GROUP BY label
    UNION ALL
    SELECT -1, NULL, round(count(*) FILTER (WHERE toxic = 0) / count(*) FILTER (WHERE toxic = 1), 6) FROM labels""",
    ))
def q_weights(spark, sf):
    w = ML.class_weights(_emb(spark, sf), "label").select("label", "n_c", r6("weight").alias("weight"))
    pw = ML.positive_weight(fx.table(spark, sf, "labels"), "toxic").select(
        F.lit(-1).alias("label"), F.lit(None).cast("bigint").alias("n_c"), r6("scale_pos_weight").alias("weight"))
    return w.unionByName(pw)


@register("random_oversample", "ML-10", with_ctes("""
    SELECT vec_id, label FROM (
      SELECT r.*, CAST(floor((m.mx - n) / n) + CASE WHEN rk < (m.mx - n) % n THEN 1 ELSE 0 END + 1 AS BIGINT) AS copies
      FROM emb_ranked r, (SELECT max(n) AS mx FROM emb_ranked) m), LATERAL (SELECT unnest(range(copies)))""",
    "emb_ranked"))
def q_over(spark, sf):
    return ML.oversample(_emb(spark, sf), "label", "vec_id").select("vec_id", "label")


@register("random_undersample", "ML-11", with_ctes("""
    SELECT vec_id, label FROM emb_ranked WHERE rk < (SELECT min(n) FROM emb_ranked)""", "emb_ranked"))
def q_under(spark, sf):
    return ML.undersample(_emb(spark, sf), "label", "vec_id").select("vec_id", "label")


@register("confusion_matrix", "ML-21", with_ctes(
    "SELECT label, prediction, count(*) AS n FROM preds GROUP BY 1, 2", "preds"))
def q_confusion(spark, sf):
    return ML.confusion(_preds(spark, sf))


_REPORT = """
    SELECT cls, support, precision, recall,
           CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
    FROM (SELECT coalesce(s.cls, p.cls) AS cls, coalesce(s.support, 0) AS support,
                 CASE WHEN coalesce(p.predicted, 0) > 0 THEN coalesce(t.tp, 0) / p.predicted ELSE 0 END AS precision,
                 CASE WHEN coalesce(s.support, 0) > 0 THEN coalesce(t.tp, 0) / s.support ELSE 0 END AS recall
          FROM (SELECT label AS cls, count(*) AS support FROM preds GROUP BY 1) s
          FULL JOIN (SELECT prediction AS cls, count(*) AS predicted FROM preds GROUP BY 1) p ON p.cls = s.cls
          LEFT JOIN (SELECT label AS cls, count(*) AS tp FROM preds WHERE label = prediction GROUP BY 1) t
                 ON t.cls = coalesce(s.cls, p.cls))"""


@register("classification_report", "ML-24", with_ctes(f"""
    SELECT cls, support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
    FROM ({_REPORT})""", "preds"))
def q_report(spark, sf):
    r = ML.class_report(_preds(spark, sf))
    return r.select("cls", "support", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@register("classification_metrics", "ML-22", with_ctes(f"""
    SELECT round(sum(recall * support) / sum(support), 6) AS accuracy,
           round(avg(CASE WHEN support > 0 THEN recall END), 6) AS balanced_accuracy,
           round(sum(precision * support) / sum(support), 6) AS precision_weighted,
           round(sum(recall * support) / sum(support), 6) AS recall_weighted,
           round(sum(f1 * support) / sum(support), 6) AS f1_weighted, round(avg(f1), 6) AS f1_macro
    FROM ({_REPORT})""", "preds"))
def q_metrics(spark, sf):
    m = ML.metrics(_preds(spark, sf))
    return m.select(*[r6(c).alias(c) for c in m.columns])


@register("binary_metrics", "ML-22", with_ctes("""
    SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy,
           round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
           round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
    FROM (SELECT count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS tp, count(*) FILTER (WHERE toxic = 0 AND quality = 0) AS fp,
                 count(*) FILTER (WHERE toxic = 1 AND quality <> 0) AS fn, count(*) FILTER (WHERE toxic = 0 AND quality <> 0) AS tn FROM labels)"""))
def q_binary(spark, sf):
    """Low quality as a forecast of toxic: the metrics of the positive class."""
    m = ML.binary_metrics(fx.table(spark, sf, "labels").withColumn("prediction", (F.col("quality") == 0).cast("int")), "toxic")
    return m.select(*[r6(c).alias(c) for c in m.columns])


@register("roc_auc", "ML-23", with_ctes("""
    SELECT 'toxic' AS target, round((sum(r) FILTER (WHERE y = 1) - npos * (npos + 1) / 2.0) / (npos * nneg), 6) AS roc_auc
    FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r,
                 count(*) FILTER (WHERE y = 1) OVER () AS npos, count(*) FILTER (WHERE y = 0) OVER () AS nneg
          FROM (SELECT l.toxic AS y, CAST(d.n_chars AS DOUBLE) AS s FROM labels l JOIN documents d ON d.doc_id = l.doc_id))
    GROUP BY npos, nneg
    UNION ALL
    SELECT 'quality', round((sum(r) FILTER (WHERE y = 1) - npos * (npos + 1) / 2.0) / (npos * nneg), 6)
    FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r,
                 count(*) FILTER (WHERE y = 1) OVER () AS npos, count(*) FILTER (WHERE y = 0) OVER () AS nneg
          FROM (SELECT l.quality AS y, CAST(d.n_chars AS DOUBLE) AS s FROM labels l JOIN documents d ON d.doc_id = l.doc_id))
    GROUP BY npos, nneg"""))
def q_auc(spark, sf):
    j = fx.table(spark, sf, "labels").join(fx.table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    out = None
    for target in ("toxic", "quality"):
        a = ML.roc_auc(j, target, "n_chars").select(F.lit(target).alias("target"), r6("roc_auc").alias("roc_auc"))
        out = a if out is None else out.unionByName(a)
    return out


@register("soft_vote", "ML-20", with_ctes("""
    SELECT vec_id, list_position(p, list_max(p)) - 1 AS prediction, round(list_max(p), 6) AS max_prob FROM (
      SELECT vec_id, list_transform(range(1, 33), lambda i: (p1[i] + p2[i]) / 2) AS p FROM (
        SELECT vec_id,
               list_transform(embedding[1:32], lambda v: exp(v) / list_sum(list_transform(embedding[1:32], lambda u: exp(u)))) AS p1,
               list_transform(embedding[33:64], lambda v: exp(v) / list_sum(list_transform(embedding[33:64], lambda u: exp(u)))) AS p2
        FROM embeddings))"""))
def q_soft_vote(spark, sf):
    e = _emb(spark, sf)

    def softmax(a):
        ex = F.transform(a, lambda v: F.exp(v.cast("double")))
        tot = F.aggregate(ex, F.lit(0.0), lambda acc, v: acc + v)
        return F.transform(ex, lambda v: v / tot)

    p = e.select("vec_id", softmax(F.slice("embedding", 1, 32)).alias("p1"), softmax(F.slice("embedding", 33, 32)).alias("p2"))
    v = ML.soft_vote(p, ["p1", "p2"])
    return v.select("vec_id", "prediction", r6(F.array_max("probability")).alias("max_prob"))


_BINNED = """
    SELECT l.feature, l.label AS y,
           CAST(CASE WHEN (r.hi - r.lo) / 10 > 0 THEN least(floor((l.x - r.lo) / ((r.hi - r.lo) / 10)), 9) ELSE 0 END AS INTEGER) AS bin
    FROM emb_long l JOIN (SELECT feature, min(x) AS lo, max(x) AS hi FROM emb_long GROUP BY 1) r ON r.feature = l.feature"""


@register("mutual_information", "ML-5", with_ctes(f"""
    SELECT feature, round(sum(n_xy / n * ln(n_xy * n / (n_x * n_y))), 6) AS mi FROM (
      SELECT feature, bin, y, n_xy, sum(n_xy) OVER (PARTITION BY feature) AS n,
             sum(n_xy) OVER (PARTITION BY feature, bin) AS n_x, sum(n_xy) OVER (PARTITION BY feature, y) AS n_y
      FROM (SELECT feature, bin, y, count(*) AS n_xy FROM ({_BINNED}) GROUP BY 1, 2, 3))
    GROUP BY feature""", "emb_long"))
def q_mi(spark, sf):
    e = _emb(spark, sf)
    mi = ML.mutual_information(ML.long_features(e, "vec_id", "embedding"), e, "vec_id", "label")
    return mi.select("feature", r6("mi").alias("mi"))


@register("select_k_best_mi", "ML-5 TOP-2", with_ctes(f"""
    SELECT feature FROM (
      SELECT feature, sum(n_xy / n * ln(n_xy * n / (n_x * n_y))) AS mi FROM (
        SELECT feature, bin, y, n_xy, sum(n_xy) OVER (PARTITION BY feature) AS n,
               sum(n_xy) OVER (PARTITION BY feature, bin) AS n_x, sum(n_xy) OVER (PARTITION BY feature, y) AS n_y
        FROM (SELECT feature, bin, y, count(*) AS n_xy FROM ({_BINNED}) GROUP BY 1, 2, 3))
      GROUP BY feature)
    ORDER BY mi DESC, feature LIMIT least(300, (SELECT count(DISTINCT feature) FROM emb_long))""", "emb_long"))
def q_kbest(spark, sf):
    e = _emb(spark, sf)
    long = ML.long_features(e, "vec_id", "embedding")
    k = min(300, len(e.select("embedding").first()[0]))       # width of the feature vector
    return ML.select_top_k(ML.mutual_information(long, e, "vec_id", "label"), "mi", k).select("feature")


@register("anova_f", "ML-6", with_ctes("""
    SELECT feature, round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS f FROM (
      SELECT g.feature, sum(g.n_g * (g.m_g - t.m) * (g.m_g - t.m)) AS ssb, sum(g.n_g * g.v_g) AS ssw,
             count(*) AS k, any_value(t.n) AS n
      FROM (SELECT feature, label, count(*) AS n_g, avg(x) AS m_g, var_pop(x) AS v_g FROM emb_long GROUP BY 1, 2) g
      JOIN (SELECT feature, count(*) AS n, avg(x) AS m FROM emb_long GROUP BY 1) t ON t.feature = g.feature
      GROUP BY g.feature)""", "emb_long"))
def q_anova(spark, sf):
    e = _emb(spark, sf)
    f = ML.anova_f(ML.long_features(e, "vec_id", "embedding"), e, "vec_id", "label")
    return f.select("feature", r6("f").alias("f"))


# ---- model fits: no SQL twin (iterative estimators); rows-only checks -----------

def _train_test(spark, sf):
    from repflow.operators import models as MD

    from repflow.plans.partitioning import materialize

    e = materialize(MD.with_vector(ML.stratified_split(_emb(spark, sf), "label", "vec_id")))
    train, test = MD.scale_vectors(e.where("split = 'train'"), e.where("split = 'test'"))
    return materialize(train), materialize(test)      # read by every (one-vs-rest) fit


@register("model_comparison", "ML-13 ML-14 ML-15 ML-16 ML-22 ML-26 SRT-1")
def q_models(spark, sf):
    from repflow.operators import models as MD

    train, test = _train_test(spark, sf)
    n_classes = _emb(spark, sf).select("label").distinct().count()
    return MD.compare_models(train, test, n_classes)


@register("cv_balanced_accuracy", "ML-18 ML-19")
def q_cv(spark, sf):
    from repflow.operators import models as MD

    from repflow.plans.partitioning import materialize

    e = materialize(MD.with_vector(MD.stratified_folds(_emb(spark, sf), "label", "vec_id")))
    rf = MD.forest(featuresCol="features", labelCol="label")
    maps = MD.random_search_maps(MD.rf_grid(rf), 8)
    cvm = MD.cross_validate(rf, e, maps)
    rows = [(i, float(m), float(s), str({p.name: v for p, v in pm.items()}))
            for i, (m, s, pm) in enumerate(zip(cvm.avgMetrics, cvm.stdMetrics, maps))]
    return spark.createDataFrame(rows, "draw int, mean_balanced_accuracy double, std double, params string")


@register("feature_importance", "ML-25 ML-4 TOP-2")
def q_importance(spark, sf):
    from repflow.operators import models as MD

    train, _ = _train_test(spark, sf)
    rf = MD.RandomForestClassifier(featuresCol="scaled", labelCol="label", numTrees=MD.SELECT_TREES, seed=MD.SEED).fit(train)
    names = [f"e{i}" for i in range(rf.numFeatures)]
    _, kept = MD.select_from_model(train, rf)
    t = MD.importance_table(rf, names).withColumn("selected", F.col("feature").isin([names[i] for i in kept]))
    return t.orderBy(F.desc("importance"), F.asc("feature")).limit(10)


@register("resampling_comparison", "ML-28 ML-10 ML-11 ML-12")
def q_resampling(spark, sf):
    from repflow.operators import models as MD

    d = _doc_feats(spark, sf).drop("f_empty")
    d = ML.median_impute(d, ["f_chars", "f_lines"])
    d = ML.stratified_split(d, "toxic", "doc_id").withColumn("label", F.col("toxic").cast("double"))
    from pyspark.ml.feature import VectorAssembler
    d = VectorAssembler(inputCols=["f_chars", "f_lines"], outputCol="features").transform(d)
    from repflow.plans.partitioning import materialize
    trs, tes = (materialize(x) for x in MD.scale_vectors(d.where("split = 'train'"), d.where("split = 'test'")))
    kw = {"featuresCol": "scaled", "labelCol": "toxic", "weightCol": "w"}
    models = {"Logistic Regression": MD.LogisticRegression(maxIter=MD.LR_ITER, **kw),
              "Random Forest": MD.forest(numTrees=100, maxDepth=MD.RF_DEPTH, **kw),
              "Gradient Boosting": MD.Boosted(maxIter=100, maxDepth=6, stepSize=0.3, seed=MD.SEED, **kw)}
    out = None
    for name, tr in MD.resampled(trs, "toxic", "doc_id").items():
        tr = materialize(tr)
        for model, est in models.items():
            row = MD.evaluate(MD.fit(est, tr).transform(tes)).select(F.lit(model).alias("Model"), F.lit(name).alias("variant"), "*")
            out = row if out is None else out.unionByName(row)
    return out


@register("ensemble_holdout", "ML-20 ML-27 ML-8")
def q_ensemble(spark, sf):
    from repflow.operators import models as MD

    train, test = _train_test(spark, sf)
    fitted = {n: MD.fit(m, train) for n, m in MD.classifiers(10).items() if n in ("Logistic Regression", "Random Forest")}
    v = MD.soft_vote_models(fitted, test, 10)
    return MD.evaluate(v)


@register("pca_embedding", "MAT-11")
def q_pca(spark, sf):
    from repflow.operators import models as MD

    e = MD.with_vector(_emb(spark, sf))
    p = MD.pca_scores(e, "features", 2)
    return p.select("vec_id", vector_to_array_col("pca"))


def vector_to_array_col(c):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(c).alias(c)


# ---- nearest neighbours: exact, checked against brute force in DuckDB -------------

def _vec(spark, sf):
    e = _emb(spark, sf)
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


CTES.update({
    "emb_vec": ((), "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings"),
    "emb_pairs": (("emb_vec",), """
        SELECT a.id AS qid, b.id AS nid, a.label AS qlabel, b.label AS nlabel,
               sqrt(list_sum(list_transform(range(1, len(a.vec) + 1), lambda i: (a.vec[i] - b.vec[i]) * (a.vec[i] - b.vec[i])))) AS dist
        FROM emb_vec a JOIN emb_vec b ON a.id <> b.id"""),
    "knn10": (("emb_pairs",), """
        SELECT qid, nid, dist, rank FROM (
          SELECT qid, nid, dist, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), nid) AS rank FROM emb_pairs)
        WHERE rank <= 10"""),
})


@register("knn_graph", "MAT-12", with_ctes(
    "SELECT qid, nid, rank, round(dist, 6) AS dist FROM knn10", "knn10"))
def q_knn_graph(spark, sf):
    from repflow.operators import neighbors as NB

    nn = NB.knn(_vec(spark, sf), 10)
    return nn.select("qid", "nid", "rank", r6("dist").alias("dist"))


@register("knn_classifier", "ML-17", with_ctes("""
    SELECT id, prediction FROM (
      SELECT qid AS id, nlabel AS prediction, row_number() OVER (PARTITION BY qid ORDER BY count(*) DESC, nlabel) AS r
      FROM (SELECT qid, nlabel FROM (
              SELECT p.qid, p.nlabel, row_number() OVER (PARTITION BY p.qid ORDER BY round(p.dist, 9), p.nid) AS rk
              FROM emb_pairs p JOIN emb_split sq ON sq.vec_id = p.qid AND sq.split = 'test'
              JOIN emb_split sn ON sn.vec_id = p.nid AND sn.split = 'train')
            WHERE rk <= 5)
      GROUP BY qid, nlabel)
    WHERE r = 1""", "emb_pairs", "emb_split"))
def q_knn_classifier(spark, sf):
    from repflow.operators import neighbors as NB

    v = _vec(spark, sf)
    split = ML.stratified_split(_emb(spark, sf), "label", "vec_id").select(F.col("vec_id").alias("id"), "split")
    v = v.join(split, "id")
    return NB.knn_classify(v.where("split = 'train'"), v.where("split = 'test'"), 5)


@register("smote_oversample", "ML-9", with_ctes("""
    SELECT s.source_id, s.j, s.label,
           round(list_sum(list_transform(range(1, len(a.vec) + 1), lambda i: a.vec[i] + s.lam * (b.vec[i] - a.vec[i]))), 6) AS vec_sum,
           round(a.vec[1] + s.lam * (b.vec[1] - a.vec[1]), 6) AS vec_first
    FROM syn s JOIN emb_vec a ON a.id = s.source_id JOIN emb_vec b ON b.id = s.nid
    UNION ALL
    SELECT id, -1, label, round(list_sum(vec), 6), round(vec[1], 6) FROM emb_vec""", "emb_pairs", "emb_ranked", extra={
    "nn": """SELECT qid, nid, rank, count(*) OVER (PARTITION BY qid) AS nk FROM (
               SELECT qid, nid, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), nid) AS rank
               FROM emb_pairs WHERE qlabel = nlabel) WHERE rank <= 5""",
    "need": """SELECT r.vec_id AS id, r.label,
                      CAST(floor((m.mx - r.n) / r.n) + CASE WHEN r.rk < (m.mx - r.n) % r.n THEN 1 ELSE 0 END AS BIGINT) AS cnt
               FROM emb_ranked r, (SELECT max(n) AS mx FROM emb_ranked) m""",
    "gen": "SELECT id, label, unnest(range(cnt)) AS j FROM need WHERE cnt > 0",
    "hh": "SELECT g.*, (g.id * 2654435761 + g.j * 7919 + 42) % 4294967296 AS hv FROM gen g",
    "syn": """SELECT hh.id AS source_id, hh.j, hh.label, ((hh.hv * 40503) % 4294967296) / 4294967296.0 AS lam, n.nid
              FROM hh JOIN (SELECT qid, max(nk) AS nk FROM nn GROUP BY qid) c ON c.qid = hh.id
              JOIN nn n ON n.qid = hh.id AND n.rank = hh.hv % c.nk + 1"""}))
def q_smote(spark, sf):
    from repflow.operators import neighbors as NB

    s = NB.smote(_vec(spark, sf), "label", 5)
    tot = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v)
    return s.select("source_id", "j", "label", r6(tot).alias("vec_sum"), r6(F.col("vec")[0]).alias("vec_first"))


@register("knn_clusters", "MAT-13")
def q_knn_clusters(spark, sf):
    """Community labels on the exact kNN graph by label propagation until they rest (``rested`` says whether they did)."""
    from repflow.operators import neighbors as NB
    from repflow.plans.partitioning import materialize

    edges = materialize(NB.knn(_vec(spark, sf), 10))
    return NB.label_propagation(edges)


@register("cohort_model_v2", "ML-27 ML-9 ML-5 ML-8 ML-18 ML-19 ML-20 ML-22")
def q_model_v2(spark, sf):
    """The v2 order without leakage: split -> scale (train stats) -> SMOTE (train only)
    -> MI top-k (train only) -> CV-tuned forest and two boosters -> soft vote -> holdout metrics."""
    from pyspark.ml.functions import array_to_vector
    from repflow.operators import models as MD
    from repflow.operators import neighbors as NB

    e = ML.stratified_split(_emb(spark, sf), "label", "vec_id")
    long = ML.long_features(e, "vec_id", "embedding").join(e.select("vec_id", "split", "label"), "vec_id")
    z = ML.standardise(long)
    rows = z.groupBy("vec_id", "split", "label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("feature", "z"))), lambda s: s["z"]).alias("vec"))
    train = rows.where("split = 'train'").select(F.col("vec_id").alias("id"), "vec", "label")
    test = rows.where("split = 'test'").select(F.col("vec_id").alias("id"), "vec", "label")
    res = NB.smote(train, "label", 5)
    # synthetic rows get positive ids of their own (deterministic)
    res = res.withColumn("id", F.when(F.col("id") == -1, F.col("source_id") * 1000003 + F.col("j") + 1000000000)
                         .otherwise(F.col("id")))
    from repflow.plans.partitioning import materialize
    res = materialize(res)           # every CV fit reads it: cut the kNN/SMOTE lineage once
    width = len(e.select("embedding").first()[0])
    mi = ML.mutual_information(ML.long_features(res, "id", "vec"), res, "id", "label")
    keep = sorted(r["feature"] for r in ML.select_top_k(mi, "mi", min(300, width)).collect())   # <= 300 indices

    def features(df):
        return df.withColumn("features", array_to_vector(F.array(*[F.col("vec")[i] for i in keep])))

    tr = materialize(MD.stratified_folds(features(res), "label", "id"))
    te = materialize(features(test))
    n_classes = tr.select("label").distinct().count()
    tuned = {name: MD.cross_validate(est, tr, maps).bestModel for name, (est, maps) in MD.searches(n_classes).items()}
    return MD.evaluate(MD.soft_vote_models(tuned, te, n_classes))
