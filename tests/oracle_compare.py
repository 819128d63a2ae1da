"""Run registered queries against their DuckDB oracle (rows, columns, values).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, int):
        return f"{float(v):.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def _key(v):
    if isinstance(v, float) and not math.isnan(v):
        return f"{v:.6g}"
    return norm(v)


def close(cols, rows, ocols, orows, rel=1e-9):
    """Row sets equal up to a relative float tolerance (rounding-boundary safe)."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = sorted(([r[i] for i in order] for r in rows), key=lambda r: [_key(v) for v in r])
    b = sorted(([r[i] for i in oorder] for r in orows), key=lambda r: [_key(v) for v in r])
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, (int, float)) and isinstance(y, (int, float)) and not isinstance(x, bool):
                x, y = float(x), float(y)
                if math.isnan(x) and math.isnan(y):
                    continue
                if abs(x - y) > rel * max(1.0, abs(x), abs(y)):
                    return False
            elif norm(x) != norm(y):
                return False
    return True


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, t + ".parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from pricewise.session import get_spark
    spark = get_spark("local[8]", 8)
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"ROWS {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sql[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and (h1 == h2 or close(cols, rows, ocols, orows))
        if ok:
            print(f"OK   {name}: {len(rows)} rows {ts:.1f}s")
        else:
            bad += 1
            print(f"FAIL {name}: rows {len(rows)} vs {len(orows)}; cols match={sorted(cols) == sorted(ocols)}")
            if sorted(cols) != sorted(ocols):
                print("   spark only:", sorted(set(cols) - set(ocols)), " oracle only:", sorted(set(ocols) - set(cols)))
            else:
                diff1 = [x for x in l1 if x not in set(l2)][:3]
                diff2 = [x for x in l2 if x not in set(l1)][:3]
                print("   cols:", sorted(cols))
                for a in diff1:
                    print("   spark :", a[:400])
                for b in diff2:
                    print("   oracle:", b[:400])
    print("failures:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
