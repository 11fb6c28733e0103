"""ML feature, resampling and evaluation operators.

Features are kept long, ``(id, feature, x)``, wherever statistics are
computed per feature (medians, variances, MI, ANOVA, scaling): one grouped
aggregate covers any width.  Models use ``pyspark.ml`` on assembled vectors.

Determinism: "random" choices (split, resampling) are made by a fixed
integer hash of the row id and the seed, so a rerun - or a retried task after
an executor loss - picks exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------
SEED = 42
TEST_FRACTION = 0.2
HASH_MULT = 2654435761          # Knuth multiplicative hash, mod 2^32
HASH_MOD = 4294967296
HASH_SAFE = 3_400_000_000       # ids up to here, times HASH_MULT, stay inside 64 bits
# ---------------------------------------------------------------------------


def hash_order(id_col: Column, seed: int = SEED) -> Column:
    """Deterministic pseudo-random order key for a non-negative integer id."""
    return hash_product(id_col, F.lit(seed))


def hash_product(id_col: Column, plus: Column) -> Column:
    """``(id * HASH_MULT + plus) % HASH_MOD`` for any bigint; large ids (of synthetic rows) are multiplied in halves of 16 bits."""
    i = id_col.cast("bigint")
    low, high = F.pmod(i, F.lit(1 << 16)), F.pmod(F.shiftright(i, 16), F.lit(1 << 16))
    halves = low * F.lit(HASH_MULT) + high * F.lit(HASH_MULT) % F.lit(1 << 16) * F.lit(1 << 16)
    return F.when(i.between(-HASH_SAFE, HASH_SAFE), (i * F.lit(HASH_MULT) + plus) % F.lit(HASH_MOD)) \
        .otherwise(F.pmod(halves + plus, F.lit(HASH_MOD)))


def long_features(df: DataFrame, id_col: str, array_col: str) -> DataFrame:
    """``array<float>`` column -> long ``(id, feature, x)`` with 0-based feature index."""
    return df.select(id_col, F.posexplode(array_col).alias("feature", "x")) \
        .withColumn("x", F.col("x").cast("double"))


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """ML-1: alphabetical label encoding of a string column (index as double)."""
    from pyspark.ml.feature import StringIndexer

    out = out or f"{col}_idx"
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc",
                          handleInvalid="keep").fit(df)
    return model.transform(df)


def median_impute(df: DataFrame, cols) -> DataFrame:
    """ML-2: fill nulls with the exact column median; all-null columns are dropped."""
    from repflow.operators.quantiles import exact_quantiles

    cols = list(cols)
    # one quantile search for all columns: (column, value) in long form; one median per column comes back
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in cols])))
    med = dict.fromkeys(cols) | {r["c"]: r["q0"] for r in exact_quantiles(long, ["c"], "x", (0.5,)).collect()}
    keep = [c for c in cols if med[c] is not None]
    out = df.drop(*[c for c in cols if c not in keep])
    return out.fillna({c: float(med[c]) for c in keep})


def feature_variance(long: DataFrame) -> DataFrame:
    """ML-3: population variance per feature and whether it passes ``> 0``."""
    v = long.groupBy("feature").agg(F.var_pop("x").alias("variance"))
    return v.withColumn("kept", F.col("variance") > 0)


def drop_constant_features(long: DataFrame) -> DataFrame:
    """ML-3: the rows of the features whose population variance is above 0 (nulls and NaN left out of it)."""
    x = F.when(F.isnan("x"), F.lit(None)).otherwise(F.col("x"))
    kept = long.groupBy("feature").agg(F.min(x).alias("__lo"), F.max(x).alias("__hi")).where("__lo < __hi")
    return long.join(kept.select("feature"), "feature", "left_semi")


RANK_BUCKETS = 4096


def rank_in_group(df: DataFrame, group: str, id_col: str, seed: int = SEED,
                  n_buckets: int = RANK_BUCKETS) -> DataFrame:
    """0-based rank of each row within ``group`` in (hash, id) order, plus group size.

    Distributed: the hash is uniform on [0, 2^32), so equal hash ranges split
    every group into ``n_buckets`` slices.  Slice sizes (groups x buckets rows,
    small) give each slice's offset; rows are ranked only inside their slice.
    A group holding a third of all rows is thus spread over many tasks.
    """
    h = hash_order(F.col(id_col), seed)
    d = df.withColumn("__h", h).withColumn("__b", (F.col("__h") * n_buckets / F.lit(HASH_MOD)).cast("int"))
    sizes = d.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("__bn"))
    before = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select(group, "__b", F.coalesce(F.sum("__bn").over(before), F.lit(0)).alias("__off"),
                        F.sum("__bn").over(Window.partitionBy(group)).alias("__n"))
    d = d.join(offs, [group, "__b"])   # groups x buckets rows; the planner broadcasts it when small
    w = Window.partitionBy(group, "__b").orderBy("__h", id_col)
    return d.withColumn("__rank", F.col("__off") + F.row_number().over(w) - 1).drop("__h", "__b", "__off")


def stratified_split(df: DataFrame, label: str, id_col: str, test_fraction: float = TEST_FRACTION,
                     seed: int = SEED) -> DataFrame:
    """ML-7: per class, the first ``round(f * n_class)`` rows in hash order are test."""
    r = rank_in_group(df, label, id_col, seed)
    split = F.when(F.col("__rank") < F.round(F.col("__n") * test_fraction), "test").otherwise("train")
    return r.withColumn("split", split).drop("__rank", "__n")


def standardise(long: DataFrame, split_col: str = "split") -> DataFrame:
    """ML-8: z-score per feature with mean and population std of the train rows."""
    stats = long.where(F.col(split_col) == "train").groupBy("feature").agg(
        F.avg("x").alias("__m"), F.stddev_pop("x").alias("__s"))
    j = long.join(F.broadcast(stats), "feature")   # one row per feature
    sd = F.when(F.col("__s") == 0, F.lit(1.0)).otherwise(F.col("__s"))
    return j.withColumn("z", (F.col("x") - F.col("__m")) / sd).drop("__m", "__s")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """ML-12: balanced weight ``n / (k * n_c)`` per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = c.agg(F.sum("n_c").alias("__n"), F.count(F.lit(1)).alias("__k"))
    j = c.withColumn("__j", F.lit(1)).join(F.broadcast(tot.withColumn("__j", F.lit(1))), "__j")
    return j.select(label, "n_c", (F.col("__n") / (F.col("__k") * F.col("n_c"))).alias("weight"))


def positive_weight(df: DataFrame, label: str) -> DataFrame:
    """ML-12: ``scale_pos_weight = n_negative / n_positive`` for a 0/1 label (null without positives)."""
    return df.agg(F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).alias("scale_pos_weight"))


def _class_extreme(r: DataFrame, label: str, fn) -> DataFrame:
    """Attach the largest/smallest class size (from the small class-size table)."""
    sizes = r.groupBy(label).agg(F.first("__n").alias("__n"))
    ext = sizes.agg(fn("__n").alias("__ext"))
    return r.withColumn("__k", F.lit(1)).join(F.broadcast(ext.withColumn("__k", F.lit(1))), "__k").drop("__k")


def oversample(df: DataFrame, label: str, id_col: str, seed: int = SEED) -> DataFrame:
    """ML-10: raise every class to the majority size.

    Class ``c`` needs ``e = max_n - n_c`` extra rows; the row of hash rank ``k``
    is repeated ``e // n_c`` times plus once more when ``k < e % n_c``.  Copies
    are generated per row (``explode``), so no class is gathered in one task.
    """
    r = _class_extreme(rank_in_group(df, label, id_col, seed), label, F.max)
    extra = F.col("__ext") - F.col("__n")
    copies = F.floor(extra / F.col("__n")) + F.when(F.col("__rank") < extra % F.col("__n"), 1).otherwise(0)
    r = r.withColumn("__copies", (copies + 1).cast("int"))
    out = r.select("*", F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__rep"))
    return out.drop("__rank", "__n", "__ext", "__copies", "__rep")


def undersample(df: DataFrame, label: str, id_col: str, seed: int = SEED) -> DataFrame:
    """ML-11: keep the first ``min_n`` rows (hash order) of every class."""
    r = _class_extreme(rank_in_group(df, label, id_col, seed), label, F.min)
    return r.where(F.col("__rank") < F.col("__ext")).drop("__rank", "__n", "__ext")


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """ML-21: counts per (label, prediction)."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """ML-24: per class precision, recall, F1, support (zero division -> 0)."""
    c = confusion(df, label, pred)
    tp = c.where(F.col("label") == F.col("prediction")).select(F.col("label").alias("cls"), F.col("n").alias("tp"))
    sup = c.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("support"))
    prd = c.groupBy(F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    r = sup.join(prd, "cls", "full").join(tp, "cls", "left").fillna(0, ["tp", "support", "predicted"])
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rc = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    r = r.select("cls", "support", p.alias("precision"), rc.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return r.withColumn("f1", f1)


def metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """ML-22: accuracy, balanced accuracy, weighted precision/recall/F1, macro F1."""
    r = class_report(df, label, pred)
    tot = F.sum("support")
    present = F.col("support") > 0
    return r.agg(
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("accuracy"),
        F.avg(F.when(present, F.col("recall"))).alias("balanced_accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision_weighted"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall_weighted"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"))


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", positive: int = 1) -> DataFrame:
    """ML-22 for two classes: accuracy, balanced accuracy, and precision, recall and F1 of the ``positive`` class.

    A share of nothing is 0; balanced accuracy averages over the classes present; an empty table gives nulls for both accuracies.
    """
    y, p = F.col(label) == positive, F.col(pred) == positive
    c = df.where(F.col(label).isNotNull()).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~F.coalesce(p, F.lit(False))).alias("fn"),
        F.count_if(~y & ~F.coalesce(p, F.lit(False))).alias("tn"))
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    recall, spec = F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    zero = F.lit(0.0)
    return c.select(F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    F.coalesce((recall + spec) / 2, recall, spec).alias("balanced_accuracy"),
                    F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"), F.coalesce(recall, zero).alias("recall"),
                    F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero).alias("f1"))


def cumulative_before(t: DataFrame, order_col: str, value_col: str) -> DataFrame:
    """``before``: sum of the whole number ``value_col`` over rows with a smaller ``order_col`` (distinct keys, not null).

    Distributed prefix sum over range partitions (:func:`repflow.operators.ranks.running_before`); their number follows
    the session's shuffle partitions.  An empty table gives no rows.
    """
    from repflow.operators.ranks import running_before

    return running_before(t, [], [order_col], value_col)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """ML-23: exact ROC AUC (Mann-Whitney U, ties count one half); null unless binary, null for an empty table.

    Rows without a score take no part.

    Rows are first reduced to one row per distinct score (map-side combine),
    then negatives below each score come from a distributed prefix sum.
    """
    t = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"),
        F.count_if(F.col(label).isNotNull() & ~F.col(label).isin(0, 1)).alias("other"))
    c = cumulative_before(t, "s", "neg")
    a = c.agg(F.sum(F.col("pos") * (F.col("before") + 0.5 * F.col("neg"))).alias("u"),
              F.sum("pos").alias("npos"), F.sum("neg").alias("nneg"), F.sum("other").alias("nother"))
    auc = F.try_divide(F.col("u"), F.col("npos") * F.col("nneg"))
    ok = (F.col("npos") > 0) & (F.col("nneg") > 0) & (F.col("nother") == 0)
    return a.select(F.when(ok, auc).alias("roc_auc"))


def soft_vote(df: DataFrame, prob_cols) -> DataFrame:
    """ML-20: mean of the models' class-probability arrays, then argmax."""
    cols = [F.col(c) for c in prob_cols]
    mean = F.zip_with(cols[0], cols[1], lambda a, b: a + b)
    for c in cols[2:]:
        mean = F.zip_with(mean, c, lambda a, b: a + b)
    mean = F.transform(mean, lambda x: x / len(cols))
    best = F.array_position(mean, F.array_max(mean)) - 1
    return df.withColumn("probability", mean).withColumn("prediction", best.cast("int"))


def equal_width_bins(long: DataFrame, n_bins: int = 10) -> DataFrame:
    """Bin each feature into ``n_bins`` equal-width bins over its own range."""
    rng = long.groupBy("feature").agg(F.min("x").alias("__lo"), F.max("x").alias("__hi"))
    j = long.join(F.broadcast(rng), "feature")   # one row per feature
    width = (F.col("__hi") - F.col("__lo")) / n_bins
    b = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("__lo")) / width), F.lit(n_bins - 1))).otherwise(0)
    return j.withColumn("bin", b.cast("int")).drop("__lo", "__hi")


def mutual_information(long: DataFrame, labels: DataFrame, id_col: str, label: str, n_bins: int = 10) -> DataFrame:
    """ML-5: mutual information (nats) between each binned feature and the label.

    Binned plug-in estimator from a contingency table (the reference uses a
    nearest-neighbour estimator; documented deviation).
    """
    b = equal_width_bins(long, n_bins).join(labels.select(id_col, F.col(label).alias("y")), id_col)
    n = F.sum("n_xy").over(Window.partitionBy("feature"))
    ct = b.groupBy("feature", "bin", "y").agg(F.count(F.lit(1)).alias("n_xy"))
    ct = ct.withColumn("n", n).withColumn("n_x", F.sum("n_xy").over(Window.partitionBy("feature", "bin"))) \
        .withColumn("n_y", F.sum("n_xy").over(Window.partitionBy("feature", "y")))
    term = F.col("n_xy") / F.col("n") * F.log(F.col("n_xy") * F.col("n") / (F.col("n_x") * F.col("n_y")))
    return ct.groupBy("feature").agg(F.sum(term).alias("mi"))


def select_top_k(scores: DataFrame, score_col: str, k: int) -> DataFrame:
    """Top-``k`` features by score (ties: smaller feature index)."""
    return scores.orderBy(F.desc(score_col), F.asc("feature")).limit(k)


def anova_f(long: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """ML-6: one-way ANOVA F statistic per feature across label classes."""
    j = long.join(labels.select(id_col, F.col(label).alias("y")), id_col)
    g = j.groupBy("feature", "y").agg(F.count(F.lit(1)).alias("n_g"), F.avg("x").alias("m_g"),
                                      F.var_pop("x").alias("v_g"))
    tot = j.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"))
    g = g.join(tot, "feature")
    s = g.groupBy("feature").agg(
        F.sum(F.col("n_g") * (F.col("m_g") - F.col("m")) ** 2).alias("ssb"),
        F.sum(F.col("n_g") * F.col("v_g")).alias("ssw"),
        F.count(F.lit(1)).alias("k"), F.first("n").alias("n"))
    # no spread within the classes: infinite, or not a number when the class means agree too
    between = F.try_divide(F.col("ssb"), F.col("k") - 1)
    within = F.try_divide(F.col("ssw"), F.col("n") - F.col("k"))
    flat = F.when(between > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return s.select("feature", F.when(within == 0, flat).otherwise(F.try_divide(between, within)).alias("f"))
