"""Language ID by a string kernel.

Kernel: blended spectrum of presences.  A text is the set ``G`` of its distinct
1- to 3-byte n-grams (UTF-8, A-Z lower-cased) and
``k(x, z) = |G(x) & G(z)| / sqrt(|G(x)| |G(z)|)``.  A bounded, seeded sample of
labelled rows is drawn per language; part of it are the Nystroem landmarks.
One-versus-rest kernel ridge regression on the landmark kernel is solved in
closed form on the driver (a landmarks x landmarks system).

``f(x) = K(x, landmarks) a`` is linear in the presences of ``x``, so landmarks and
coefficients fold into one matrix (n-grams of the landmarks x languages) and a
batch of texts is scored by one product of its presence matrix with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repflow.llm.textkernel import LOWER, runs, utf8

UND = "und"
ROWS_AT_ONCE = 128
HASH_RANGE = 1 << 30


def grams(text: np.ndarray) -> np.ndarray:
    """Sorted distinct codes of a text's 1- to 3-byte n-grams."""
    b = LOWER[text].astype(np.int32)
    two = (b[:-1] << 8) | b[1:]
    three = (two[:-1] << 8) | b[2:]
    s = np.sort(np.concatenate([three, two + (1 << 24), b + ((1 << 24) + (1 << 16))]))
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, label: Column, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        per_language: int = 256, landmarks: int = 32, ridge: float = 1e-3, seed: int = 11) -> dict:
    """Model from at most ``per_language`` sampled rows of each language, ``landmarks`` of them landmarks.

    ``learn`` selects the rows that may be used; rows without label or letter
    never are.  Sampled texts enter whole, as n-gram sets.
    """
    text = F.col(text_col).cast("string")
    pool = docs.where(F.coalesce(learn, F.lit(False))).select(
        label.cast("string").alias("lang"), text.alias("text"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(HASH_RANGE)).alias("h")).where("lang IS NOT NULL")
    sizes = {r[0]: r[1] for r in pool.groupBy("lang").count().collect()}       # one row per language
    empty = {"langs": [], "codes": np.zeros(0, np.int32), "weights": np.zeros((0, 0), np.float32)}
    if not sizes:
        return empty
    limit = F.coalesce(*[F.when(F.col("lang") == k, F.lit(int(HASH_RANGE * min(1.0, 1.5 * per_language / n))))
                         for k, n in sorted(sizes.items())])
    sample = pool.where((F.col("h") < limit) & has_letter(F.col("text")))

    def to_sets(batches):
        for b in batches:
            buf, off = utf8(b.column("text"))
            yield pa.record_batch([b.column("lang"), b.column("h"), pa.array(
                [grams(buf[s:e]).tobytes() for s, e in zip(off[:-1], off[1:])], pa.binary())], names=["lang", "h", "g"])

    got: dict[str, list] = {}
    for r in sorted(sample.mapInArrow(to_sets, "lang string, h long, g binary").collect(),
                    key=lambda r: (r["lang"], r["h"], bytes(r["g"]))):
        rows = got.setdefault(r["lang"], [])
        if len(rows) < per_language:
            rows.append(np.frombuffer(r["g"], np.int32))
    if not got:
        return empty
    langs = sorted(got)
    marks = [g for k in langs for g in got[k][:landmarks]]
    codes = np.unique(np.concatenate(marks))
    unit = np.zeros((len(codes), len(marks)), np.float32)         # landmarks as unit vectors over their n-grams
    for j, g in enumerate(marks):
        unit[np.searchsorted(codes, g), j] = 1 / np.sqrt(len(g))
    k_nm, y = [], []
    for i, k in enumerate(langs):
        for g in got[k]:
            at = np.minimum(np.searchsorted(codes, g), len(codes) - 1)
            k_nm.append(unit[at[codes[at] == g]].sum(0) / np.sqrt(len(g)))
            y.append(np.where(np.arange(len(langs)) == i, 1.0, -1.0))
    k_nm, y, k_mm = np.asarray(k_nm, np.float64), np.asarray(y), (unit.T @ unit).astype(np.float64)
    a = np.linalg.solve(k_nm.T @ k_nm + ridge * len(y) * (k_mm + 1e-6 * np.eye(len(marks))), k_nm.T @ y)
    return {"langs": langs, "codes": codes.astype(np.int32), "weights": (unit @ a).astype(np.float32)}


def predict(docs: DataFrame, model: dict, carry: dict[str, Column], text_col: str = "text") -> DataFrame:
    """Columns ``carry`` plus ``lang_pred`` and ``score`` (the margin of the best language, mapped to 0..1)."""
    langs = np.array(model["langs"] or [UND], dtype=object)
    shared, names = docs.sparkSession.sparkContext.broadcast((model["codes"], model["weights"])), list(carry)
    src = docs.select(*[c.alias(n) for n, c in carry.items()], F.col(text_col).cast("string").alias("__text"),
                      has_letter(F.col(text_col).cast("string")).alias("__letter"))

    def to_lang(batches):
        codes, weights = shared.value
        for b in batches:
            best, score = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            buf, off = utf8(b.column("__text"))
            letter = b.column("__letter").to_numpy(zero_copy_only=False).astype(bool) & bool(len(codes))
            for i, j in runs(off):
                for s in range(i, j, ROWS_AT_ONCE):
                    t = min(j, s + ROWS_AT_ONCE)
                    x = np.zeros((t - s, len(codes)), np.float32)
                    for r in np.flatnonzero(letter[s:t]):
                        g = grams(buf[off[s + r]:off[s + r + 1]])
                        at = np.minimum(np.searchsorted(codes, g), len(codes) - 1)
                        x[r, at[codes[at] == g]] = 1 / np.sqrt(len(g))
                    f = x @ weights if len(codes) else np.zeros((t - s, 1), np.float32)
                    best[s:t] = f.argmax(1)
                    score[s:t] = np.clip((f.max(1) + 1) / 2, 0, 1)
            name = langs[best]
            name[~letter] = UND
            score[~letter] = 0.0
            yield pa.record_batch([b.column(n) for n in names] + [pa.array(name, pa.string()), pa.array(score)],
                                  names=[*names, "lang_pred", "score"])

    kept = src.select(*names).schema
    return src.mapInArrow(to_lang, kept.add("lang_pred", "string").add("score", "double"))


def identify(docs: DataFrame, held_out: Column, label_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
             **kw) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per input row.

    Learns from rows that are not held out and have a label and a letter;
    label, source and id never enter a prediction.  Null, empty and letterless
    texts are ``und`` with score 0, as is every text when nothing can be
    learnt; a null id counts as held out.  Ties go to the first language in
    order.  An empty table gives no rows; other columns are ignored.
    """
    out = F.coalesce(held_out, F.lit(True))
    model = fit(docs, F.col(label_col), ~out, id_col, text_col, **kw)
    return predict(docs, model, {"doc_id": F.col(id_col).cast("long"), "held_out": out}, text_col)
