"""Run registered queries on Spark and their SQL on DuckDB; compare results.

Usage: python -m tests.oracle_check [sf_dir] [name ...]
Comparison: same column names (sorted), same row count, same multiset of rows
(doubles compared after rounding to 9 significant digits, as a tolerance for
last-bit differences in order-dependent double sums).
"""

from __future__ import annotations

import math
import os
import sys
import time

STRICT = os.environ.get("ORACLE_STRICT") == "1"  # compare raw doubles, no tolerance

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == 0:
            return 0.0
        return v if STRICT else float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, build, sql, sf_dir):
    t0 = time.time()
    sdf = build(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, status="rows-only", rows=len(s_rows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows), spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2))
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"COLUMNS {sorted(s_cols)} != {sorted(d_cols)}"
        return out
    a = rows_of(s_cols, s_rows)
    b = rows_of(d_cols, d_rows)
    if a == b:
        out["status"] = "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["status"] = "MISMATCH"
        out["example"] = diff
        out["columns"] = sorted(s_cols)
    return out


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from stressframe.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs = entry.queries()
    sqls = entry.oracle_sql()
    bad = 0
    for name, build in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, build, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, status=f"ERROR {type(e).__name__}: {str(e)[:400]}")
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"DONE bad={bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
