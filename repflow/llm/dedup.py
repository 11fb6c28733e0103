"""Exact dedup: tree-merge of sorted digest runs.

1. Every partition turns its rows into one sorted run of ``(digest, best id,
   rows)``: one entry per distinct text of the partition, so a text that
   makes up a third of all rows leaves a partition as a single entry.
2. The ``fan ** rounds`` nodes exchange runs in rounds, as in a binomial
   (radix-``fan``) exchange.  In round ``r`` the entry of digest ``d`` moves from
   node ``p`` to the node that equals ``p`` but for digit ``r``, which becomes
   digit ``r`` of ``d``'s own range.  A node merges at most ``fan`` runs per
   round and keeps, per digest, the best id and the sum of the rows.
3. After the last round each node holds one finished, disjoint digest range.

Equality is by SHA-256 of the normalised text, verified at every merge by the
text's byte length (entries of one digest with different lengths end the job).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repflow.llm.tables import n_slices
from repflow.llm.textkernel import LOWER, utf8

RUN = "node int, digest binary, best long, n_rows long, n_bytes long"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def _digested(batches):
    """Batches ``(id, digest, n_bytes)`` of batches ``(id, text)``."""
    for b in batches:
        buf, off = utf8(b.column("text"))
        low = LOWER[buf].tobytes()
        yield pa.record_batch([
            b.column("id"),
            pa.array([hashlib.sha256(low[s:e]).digest() for s, e in zip(off[:-1], off[1:])], pa.binary()),
            pa.array(np.diff(off), pa.int64())], names=["id", "digest", "n_bytes"])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, digest, n_bytes)`` per row; A-Z lower-cased, null text counts as empty."""
    return _texts(docs, id_col, text_col).mapInArrow(_digested, "id long, digest binary, n_bytes long")


def _merge(t: pa.Table, largest: bool) -> pa.Table:
    """Multiway merge of the runs in ``t``: one entry per digest, in digest order."""
    g = t.group_by("digest").aggregate([("best", "max" if largest else "min"), ("n_rows", "sum"),
                                        ("n_bytes", "min"), ("n_bytes", "max")])
    if not g["n_bytes_min"].equals(g["n_bytes_max"]):
        raise ValueError("two different texts share a SHA-256 digest")
    return g.select(["digest", f"best_{'max' if largest else 'min'}", "n_rows_sum", "n_bytes_min"]) \
        .rename_columns(["digest", "best", "n_rows", "n_bytes"]).sort_by("digest")


def tree_merge(runs: DataFrame, fan: int, rounds: int, largest: bool) -> DataFrame:
    """``(digest, best, n_rows, n_bytes)``, one row per digest, from ``(node, digest, ...)`` runs."""
    nodes = fan ** rounds
    own = F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), F.lit(nodes)).cast("int")
    for r in range(rounds):
        unit = fan ** r
        digit = F.floor(F.col("node") / unit).cast("int") % fan
        wanted = F.floor(own / unit).cast("int") % fan
        moved = runs.withColumn("node", F.col("node") + (wanted - digit) * unit)

        def merge(t: pa.Table) -> pa.Table:
            out = _merge(t.drop_columns("node"), largest)
            return out.add_column(0, "node", pa.array(np.full(len(out), t["node"][0].as_py()), pa.int32()))

        runs = moved.groupBy("node").applyInArrow(merge, RUN)
    return runs.drop("node")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                fan: int = 8) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per input row.

    Texts are equal when identical after lower-casing A-Z only.  Of equal
    texts the row with the largest (``keep='smallest'``: smallest) id stays.
    Null text counts as empty; empty texts are equal to each other.  A null id
    stays only in a group without any id (``keep_id`` null).  Rows with
    repeated id and text count as separate rows of the group and share the
    ``kept`` flag.  An empty table gives no rows; other columns are ignored.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    largest = keep == "largest"
    rows = digests(docs, id_col, text_col)
    rounds = max(1, int(np.ceil(np.log(max(2, n_slices(docs))) / np.log(fan))))
    nodes = fan ** rounds

    def to_run(batches):
        parts = []
        for b in _digested(batches):             # in the same worker: a chain of two would start two for each task
            parts.append(_merge(pa.table({"digest": b.column("digest"), "best": b.column("id"),
                                          "n_rows": pa.array(np.ones(b.num_rows), pa.int64()),
                                          "n_bytes": b.column("n_bytes")}), largest))
            if len(parts) >= 8:
                parts = [_merge(pa.concat_tables(parts), largest)]
        if parts:
            out = _merge(pa.concat_tables(parts), largest)
            node = TaskContext.get().partitionId() % nodes
            out = out.add_column(0, "node", pa.array(np.full(len(out), node), pa.int32()))
            yield from out.to_batches()

    best = tree_merge(_texts(docs, id_col, text_col).mapInArrow(to_run, RUN), fan, rounds, largest)
    won = best.select(F.col("digest").alias("d"), "best", "n_rows")
    return rows.join(won, F.col("digest") == F.col("d")).select(
        F.col("id").alias("doc_id"), F.col("best").alias("keep_id"), F.col("n_rows").alias("group_size"),
        F.col("id").eqNullSafe(F.col("best")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
