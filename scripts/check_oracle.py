"""Run registered Spark queries and their DuckDB twins side by side.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
Prints one line per query: rows, columns and an order-insensitive value check.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from repflow.plans.fixtures import TABLES  # noqa: E402
from repflow.plans.registry import ORACLE, QUERIES, load_all  # noqa: E402
from repflow.session import get_spark  # noqa: E402


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{round(v, 6):.6f}")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, int):
        return (1, f"{float(v):.6f}")
    return (1, str(v))


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], sorted(columns)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    load_all()
    if os.environ.get("PLAIN_SESSION"):       # a bare session, as the driver may build it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = get_spark()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            print(f"ROWS {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(ORACLE[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        a, ac = canon(cols, rows)
        b, bc = canon(ocols, orows)
        ok = ac == bc and sorted(a) == sorted(b)
        if not ok:
            bad += 1
            print(f"FAIL {name}: spark {len(rows)} rows {ac[:8]} / duckdb {len(orows)} rows {bc[:8]}")
            sa, sb = sorted(a), sorted(b)
            diff = [x for x in sa if x not in set(sb)][:3]
            print("   spark-only sample:", diff)
            print("   duckdb-only sample:", [x for x in sb if x not in set(sa)][:3])
        else:
            print(f"OK   {name}: {len(rows)} rows {ts:.1f}s")
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
