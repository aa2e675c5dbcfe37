"""Run registered queries in Spark and their SQL oracles in DuckDB on one
data folder and compare (row count, column names, values)."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from chronopanel.plans.registry import load_all, runner  # noqa: E402
from chronopanel.session import TABLES, build_session  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if not hasattr(v, "hour") else v.isoformat()
    return v


def main():
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    only = set(sys.argv[1:])
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    reg = load_all()
    bad = 0
    for name, q in reg.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = runner(q)(spark, sf)
            srows = sdf.collect()
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:600]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(q.sql)
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns spark={scols} duck={dcols}")
            bad += 1
            continue
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        a = sorted((tuple(norm(r[i]) for i in si) for r in srows), key=repr)
        b = sorted((tuple(norm(r[i]) for i in di) for r in drows), key=repr)
        if len(a) != len(b):
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)}")
            bad += 1
            continue
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            print(f"FAIL {name}: {len(diff)} value diffs, cols={order}, first: {diff[:2]}")
            bad += 1
            continue
        print(f"OK   {name}: {len(a)} rows {ts:.1f}s")
    print(f"bad={bad}")
    spark.stop()


if __name__ == "__main__":
    main()
