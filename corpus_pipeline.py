"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

1. ``language_id``: documents without a recognisable language (no letter) go.
2. ``exact_dedup``: of equal texts (A-Z lower-cased) the row with the largest id stays.
3. ``ngram_jaccard``: of each group of near copies (five-word shingles, Jaccard 0.75) the row with the smallest id stays.
4. ``mix_sources``: every document as often as the capped mix of the sources takes it.
5. ``pack_sequences``: sequences of at most 2048 ids; one row per piece.

The first four return the columns of ``documents``.  A stage's result has as many partitions, so as many files, as its texts
ask for.  Stages that drop or repeat rows
join their decisions to the rows by the id; rows of one id share its decision, a null
id is an id of its own.  Every stage takes an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repflow.llm.dedup import exact_dedup
from repflow.llm.jaccard import jaccard_components
from repflow.llm.langid import UND, fit, has_letter, predict
from repflow.llm.mixing import mixed_documents
from repflow.llm.packing import pack
from repflow.llm.tables import crc_mod, n_files, scratch

# language ID, dedup, near dedup and packing cannot all be written as SQL
ORACLE_SQL = None


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids`` (one column ``doc_id``)."""
    ids = ids.select(F.col("doc_id").alias("__kept_id"))
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("__kept_id")), "left_semi")


def language_id(docs: DataFrame, files: int) -> DataFrame:
    """Learns as the query does; keeps what is in a learnt language."""
    model = fit(docs, F.col("lang"), F.coalesce(crc_mod(F.col("doc_id"), 3) != 1, F.lit(False)))
    if not model["langs"]:                       # nothing to learn from: only texts without a letter go
        return docs.where(has_letter(F.col("text")))
    told = predict(docs, model, {"row": F.struct(*[F.col(f"`{c}`") for c in docs.columns])}, "text")
    return told.where(F.col("lang_pred") != UND).select("row.*")


def dedup_exact(docs: DataFrame, files: int) -> DataFrame:
    """Keeps the row with the largest id of every group of equal texts."""
    kept = exact_dedup(docs).where("kept")
    return _only(docs, kept)


def dedup_near(docs: DataFrame, files: int) -> DataFrame:
    """Keeps the row with the smallest id of every group of near copies."""
    kept = jaccard_components(docs, files=files).where("doc_id <=> component_id")
    return _only(docs, kept)


def mix(docs: DataFrame, files: int) -> DataFrame:
    """The rows as often as the mix takes them."""
    return mixed_documents(docs, files=files)


def packed(docs: DataFrame, files: int) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack(docs)


def _fitted(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        files = n_files(docs)
        return stage(docs, files).coalesce(files)

    return run_stage


STAGES = [(name, _fitted(stage)) for name, stage in (
    ("language_id", language_id), ("exact_dedup", dedup_exact), ("ngram_jaccard", dedup_near), ("mix_sources", mix), ("pack_sequences", packed))]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
