"""Every registered query with a SQL twin equals DuckDB at sf0.001."""

import math

import duckdb
import pytest

from repflow.plans.fixtures import TABLES
from repflow.plans.registry import ORACLE, QUERIES, load_all

load_all()
SF = "/root/testdata/sf0.001"


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if v is None:
            return ""
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return "nan" if isinstance(v, float) and math.isnan(v) else f"{round(float(v), 6):.6f}"
        return str(v)
    return sorted(tuple(norm(r[i]) for i in order) for r in rows), sorted(cols)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF)
    mine = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[name])
    theirs = _canon([d[0] for d in cur.description], cur.fetchall())
    assert mine[1] == theirs[1]
    assert mine[0] == theirs[0]
