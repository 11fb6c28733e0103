"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SURVEY_IDS: dict[str, str] = {}


def register(name: str, ids: str, sql: str | None = None):
    """Register a query builder under ``name`` covering SURVEY ids ``ids``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        SURVEY_IDS[name] = ids
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c) -> Column:
    """Round doubles to 6 places (both engines do the same in the oracle)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def load_all() -> None:
    """Import every catalog module so its queries register."""
    from repflow.plans import (catalog_sequence, catalog_cohort, catalog_singlecell,  # noqa: F401
                               catalog_matrix, catalog_ml, catalog_files,
                               catalog_structure)
