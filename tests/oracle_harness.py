"""Run a driver query on Spark and its SQL twin on DuckDB; compare.

Comparison: same column names, same row count, same multiset of rows (columns
sorted by name, values normalised to text).  Usable from pytest and as
``python tests/oracle_harness.py <sf_dir> [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v) -> str:
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 6))
    if hasattr(v, "is_nan") and v.is_nan():
        return "∅"
    if type(v).__name__ == "Decimal":
        return repr(round(float(v), 6))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def rows_of(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    from trimatch.plans.oracles import ORACLES
    from trimatch.plans.queries import QUERIES

    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(ORACLES[name])
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    t2 = time.time()
    s_cols = sdf.columns
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_ok": sorted(s_cols) == sorted(d_cols), "spark_s": round(t1 - t0, 2),
           "duck_s": round(t2 - t1, 2)}
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["values_ok"] = a == b
    if not out["cols_ok"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
    if out["cols_ok"] and not out["values_ok"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_duck"] = sorted(sb - sa)[:3]
    out["ok"] = out["cols_ok"] and out["values_ok"] and len(s_rows) == len(d_rows)
    return out


def main(argv: list[str]) -> int:
    from trimatch.plans.queries import QUERIES
    from trimatch.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    if os.environ.get("STAGED") == "1":   # run against staged legs instead
        from trimatch.sources.tpch_legs import stage_legs
        stage_legs(spark, sf_dir, refresh=True)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue with the next query
            r = {"name": n, "ok": False, "error": repr(e)[:600]}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
