"""Scalar column functions (SCL-1..12), all built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
SAMPLE_NAME_STRIP = ("matched_", ".dedup", ".parquet")
# Ordered condition recode: first substring hit (case-insensitive) wins.
CONDITION_RECODE = (("control", "Control"), ("uc", "UC"), ("cd", "CD"))
SRX_PATTERN = r"(SRX\d+)"
# ---------------------------------------------------------------------------


def log10_plus1(c: Column) -> Column:
    """SCL-1: ``log10(x + 1)``."""
    return F.log10(c + F.lit(1))


def log1p(c: Column) -> Column:
    """SCL-2."""
    return F.log1p(c)


def clean_match_barcode(c: Column) -> Column:
    """SCL-3: remove every ``Z:``, turn ``*`` into ``-1``, then remove every ``-1``.

    A null barcode stays null (the reference turns it into the text ``None``;
    documented deviation).
    """
    x = F.replace(c.cast("string"), F.lit("Z:"), F.lit(""))
    x = F.replace(x, F.lit("*"), F.lit("-1"))
    return F.replace(x, F.lit("-1"), F.lit(""))


def clean_expression_barcode(c: Column) -> Column:
    """SCL-4: remove every ``-1``."""
    return F.replace(c, F.lit("-1"), F.lit(""))


def clean_vdj_barcode(c: Column) -> Column:
    """SCL-5: remove only a trailing ``-1``."""
    return F.regexp_replace(c, "-1$", "")


def extract_srx(c: Column) -> Column:
    """SCL-6: drop ``_vdj`` and take the first ``SRX<digits>``; null when absent."""
    x = F.regexp_extract(F.replace(c, F.lit("_vdj"), F.lit("")), SRX_PATTERN, 1)
    return F.nullif(x, F.lit(""))


def first_digits(c: Column) -> Column:
    """SCL-7: first run of digits, null when there is none."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit(""))


def url_tail(c: Column) -> Column:
    """SCL-8: text after the last ``/``."""
    return F.element_at(F.split(c, "/"), -1)


def after_marker(c: Column, marker: str) -> Column:
    """SCL-8: trimmed text after the first ``:`` of a line holding ``marker``; else null."""
    parts = F.split(c, ":")
    return F.when(c.contains(marker) & (F.size(parts) > 1), F.trim(F.element_at(parts, 2)))


def recode_condition(c: Column) -> Column:
    """SCL-9: ordered case-insensitive recode; first hit wins, unmatched kept.

    The value is stringified first, so a null becomes the text ``nan``.
    """
    c = F.coalesce(c.cast("string"), F.lit("nan"))
    low = F.lower(c)
    out = None
    for needle, label in CONDITION_RECODE:
        out = (F.when(low.contains(needle), F.lit(label)) if out is None
               else out.when(low.contains(needle), F.lit(label)))
    return out.otherwise(c)


def is_mito(gene: Column, prefix: str = "MT-") -> Column:
    """SCL-10."""
    return gene.startswith(prefix)


def upper_str_or_empty(c: Column) -> Column:
    """SCL-11: cast to string, upper-case, null becomes ``''``."""
    return F.coalesce(F.upper(c.cast("string")), F.lit(""))


def sha1_12(c: Column) -> Column:
    """SCL-12: first 12 hex digits of SHA-1."""
    return F.substring(F.sha1(c.cast("binary")), 1, 12)


def normalise_sample_name(c: Column) -> Column:
    """SRC-7: strip ``matched_``, ``.dedup`` and ``.parquet`` (every occurrence)."""
    x = c
    for token in SAMPLE_NAME_STRIP:
        x = F.replace(x, F.lit(token), F.lit(""))
    return x


def contains_ci(c: Column, needle: str) -> Column:
    """FLT-3: case-insensitive contains, null is false."""
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def contains_cs(c: Column, needle: str) -> Column:
    """FLT-4: case-sensitive contains, null is false."""
    return F.coalesce(c.contains(needle), F.lit(False))
