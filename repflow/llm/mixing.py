"""Mixing sources to target weights by capped water-filling.

Every source asks for ``weight x level`` words; sources that would pass
``max_epochs`` times their size are clamped there and the excess goes to the
others in proportion to their weights, round by round, until no source is above
its cap.  The arithmetic of the rounds is exact (whole numbers).

A source then takes whole repetitions of all its documents plus a seeded
fractional one: its documents in the order of a seeded hash, as far as they fit
the rest of the target, then the one further document that comes nearest to
what is still missing.  The outcome is one small row of parameters per source
(``whole, cut, pick``), so no document is ranked or moved to be sampled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repflow.llm.tables import WORD, stored

HASH_BITS = 60
ROWS_PER_BUCKET = 4096


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(id_col: Column, seed: int) -> Column:
    """60-bit hash of ``seed:id`` (null id: empty), the same in any run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def water_fill(sources: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """``(source, weight, source_size, target)`` from ``(source, source_size)``, one row per source.

    Weights repeat over the sources in code-point order, null last.  A source
    of size 0 has target 0.  The rounds keep only scalars on the driver.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    s = stored(sources.select("source", weight.cast("long").alias("weight"), F.col("source_size").cast("long")), "sources")
    cap = F.col("source_size") * max_epochs
    total = s.agg(F.sum("source_size")).first()[0] or 0
    held, free_words, free_weight, clamped = -1, total, 0, F.lit(False)
    while True:
        r = s.agg(F.count_if(clamped), F.sum(F.when(clamped, cap)), F.sum(F.when(~clamped, F.col("weight")))).first()
        if r[0] == held:
            break
        held, free_words, free_weight = r[0], total - (r[1] or 0), r[2] or 0
        # above its cap: weight * free_words / free_weight > cap
        clamped = F.col("weight").cast("decimal(38,0)") * F.lit(free_words) > cap.cast("decimal(38,0)") * F.lit(free_weight)
    share = (F.col("weight") * F.lit(free_words)).cast("double") / F.lit(float(max(free_weight, 1)))
    return s.withColumn("target", F.when(clamped, cap.cast("double")).otherwise(share))


def plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 7,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, params)``: narrow rows ``(id, source, size, h)`` and one row of sampling parameters per source.

    Null text has size 0; null source is a source of its own, last in order.
    """
    rows = stored(docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                              n_words(F.col(text_col).cast("string")).alias("size"),
                              seeded_hash(F.col(id_col).cast("long"), seed).alias("h")), "mixrows", files)
    bits = max(0, math.ceil(math.log2(max(1, rows.count() / ROWS_PER_BUCKET))))
    rows = rows.withColumn("bucket", F.shiftright("h", HASH_BITS - bits))
    buckets = stored(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mixbuckets",
                     docs.sparkSession.sparkContext.defaultParallelism)
    filled = water_fill(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    filled = filled.withColumn("whole", F.least(whole, F.lit(max_epochs)).cast("long")) \
        .withColumn("gap", F.col("target") - F.col("whole") * F.col("source_size"))
    # the bucket in which the gap ends, per source; only its rows are put in order
    run = Window.partitionBy("source").orderBy("bucket")
    f = filled.select(F.col("source").alias("s"), "gap")
    b = buckets.withColumn("upto", F.sum("words").over(run)).withColumn("base", F.col("upto") - F.col("words"))
    b = b.join(f, F.col("source").eqNullSafe(F.col("s"))).where("base <= gap")
    last = b.groupBy("s").agg(F.max_by(F.struct("bucket", "base", "gap"), "bucket").alias("l")).select("s", "l.*")
    at = rows.join(last.withColumnRenamed("bucket", "b"), F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    upto = F.col("base") + F.sum("size").over(Window.partitionBy("s").orderBy("h", "id"))
    cut = at.withColumn("upto", upto).where("upto <= gap").groupBy("s").agg(
        F.max(F.struct("h", "id")).alias("cut"), F.max("upto").alias("cut_words"))
    # without such a row the cut lies before the bucket's first row
    cut = last.select("s", "bucket", "base").join(cut.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2")), "left").select(
        "s", F.coalesce(F.col("cut.h"), F.shiftleft("bucket", HASH_BITS - bits) - 1).alias("cut_h"),
        F.col("cut.id").alias("cut_id"), F.coalesce("cut_words", "base").alias("cut_words"))
    params = filled.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s") \
        .withColumn("missing", F.col("gap") - F.coalesce("cut_words", F.lit(0)))
    params = stored(params, "mixcuts")
    p = params.select(F.col("source").alias("s"), "cut_h", "cut_id", "missing")
    near = F.abs(F.col("size") - F.col("missing"))
    pick = rows.join(p, F.col("source").eqNullSafe(F.col("s"))).where(~_in_cut() & (near < F.col("missing"))) \
        .groupBy("s").agg(F.min(F.struct(near.alias("near"), "h", "id")).alias("pick")) \
        .select("s", F.col("pick.h").alias("pick_h"), F.col("pick.id").alias("pick_id"))
    params = params.join(pick, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return rows.drop("bucket"), stored(params, "mixparams")


def _in_cut() -> Column:
    # ids order after null, as in the sort by (h, id)
    upto_id = F.col("id").isNull() | F.coalesce(F.col("id") <= F.col("cut_id"), F.lit(False))
    return F.coalesce((F.col("h") < F.col("cut_h")) | ((F.col("h") == F.col("cut_h")) & upto_id), F.lit(False))


def copies() -> Column:
    """Repetitions of a row ``(id, h)`` joined to its source's parameters."""
    picked = (F.col("h") == F.col("pick_h")) & F.col("id").eqNullSafe(F.col("pick_id"))
    return F.col("whole") + F.when(_in_cut() | F.coalesce(picked, F.lit(False)), 1).otherwise(0) * F.when(F.col("gap") > 0, 1).otherwise(0)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 7,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies)``, one row per input row.

    Targets share the corpus size by weight, capped at ``max_epochs`` times the
    source.  ``taken = size x copies`` and ``copies`` never passes ``max_epochs``.
    Null or empty texts have size 0; null ids sort first among equal hashes;
    repeated rows are counted one by one but sampled alike; an empty table
    gives no rows; other columns are ignored.
    """
    rows, params = plan(docs, weights, max_epochs, seed, id_col, text_col, source_col)
    p = params.withColumnRenamed("source", "s")
    return rows.join(p, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", copies()).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame, seed: int = 7, **kw) -> DataFrame:
    """The mix itself: every input row as often as it is taken, with its own columns."""
    cols = docs.columns
    _, params = plan(docs, seed=seed, **kw)
    id_col, source_col = kw.get("id_col", "doc_id"), kw.get("source_col", "source")
    p = params.select(F.col("source").alias("__s"), *[F.col(c) for c in ("whole", "gap", "cut_h", "cut_id", "pick_h", "pick_id")])
    row = F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row")
    d = docs.select(row, F.col(id_col).cast("long").alias("id"), seeded_hash(F.col(id_col).cast("long"), seed).alias("h"),
                    F.col(source_col).cast("string").alias("__source"))
    d = d.join(p, F.col("__source").eqNullSafe(F.col("__s")))
    n = copies().cast("int")
    return d.where(n > 0).select(F.explode(F.array_repeat("__row", n)).alias("__row")).select("__row.*")
