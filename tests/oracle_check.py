"""Run catalog queries against their DuckDB oracle (same check as the driver).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of values.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    vals = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return names, vals


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_s = time.time() - t0
    s_names, s_vals = canon(df.columns, rows)
    if sql is None:
        return dict(name=name, ok=None, rows=len(rows), spark_s=spark_s)
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    d_names, d_vals = canon(d_cols, d_rows)
    ok = s_names == d_names and s_vals == d_vals
    detail = {}
    if not ok:
        detail["names"] = (s_names, d_names) if s_names != d_names else None
        detail["row_counts"] = (len(s_vals), len(d_vals))
        sd = sorted(set(s_vals) - set(d_vals))[:3]
        dd = sorted(set(d_vals) - set(s_vals))[:3]
        detail["spark_only"] = sd
        detail["duck_only"] = dd
    return dict(name=name, ok=ok, rows=len(rows), spark_s=round(spark_s, 2), **detail)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as entry
    from cellcast.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    qs = entry.queries()
    sqls = entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, name, qs[name], sqls.get(name), sf_dir, con)
        except Exception as exc:  # report and continue
            r = dict(name=name, ok=False, error=f"{type(exc).__name__}: {str(exc)[:400]}")
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")


if __name__ == "__main__":
    main()
