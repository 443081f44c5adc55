"""Compare registered Spark queries with their DuckDB oracle SQL.

Usable from pytest (``compare``) and as a script::

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]

Checks row count, column names and an order-insensitive comparison of
values (exact, with doubles compared after rounding to 9 significant
digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=lambda t: tuple(map(repr, t)))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r[c] for c in sorted(scols)) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    idx = [dcols.index(c) for c in sorted(dcols)]
    drows = [tuple(r[i] for i in idx) for r in drows_raw]
    out = {
        "name": name,
        "spark_rows": len(srows),
        "oracle_rows": len(drows),
        "columns_match": sorted(scols) == sorted(dcols),
        "spark_cols": scols,
        "oracle_cols": dcols,
        "secs": round(t1 - t0, 2),
    }
    a, b = _rows(srows), _rows(drows)
    out["values_match"] = a == b
    if not out["values_match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diff
    out["ok"] = out["columns_match"] and out["values_match"] and len(srows) == len(drows)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tidewatch.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            r = {"name": name, "ok": False, "error": repr(exc)[:800]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
