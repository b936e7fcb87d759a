"""Run every driver query in Spark and its oracle SQL in DuckDB and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison: same column names, same row count, same multiset of rows after
sorting columns by name and rounding floats to 6 decimals.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diffs(sdf, rel):
    s_types = dict(sdf.dtypes)
    out = []
    for name, dtype in zip(rel.columns, rel.types):
        want = SPARK_TO_DUCK.get(s_types.get(name), s_types.get(name))
        got = str(dtype)
        if got != want and not (got == "\"NULL\"" or got == "NULL"):
            out.append(f"{name}: spark={s_types.get(name)} duck={got}")
    return out


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for r in records:
        out.append(tuple(norm(r[i]) for i in order))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    from hirelens.plans.registry import QUERIES as _OWN
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(n for n in qs if n in _OWN):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as ex:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(ex).__name__}: {str(ex)[:300]}"
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = f"rows-only ({len(s_rows)} rows, {ts:.1f}s)"
            continue
        try:
            rel = con.sql(sqls[name])
            d_cols = rel.columns
            d_rows = rel.fetchall()
        except Exception as ex:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {type(ex).__name__}: {str(ex)[:300]}"
            continue
        if sorted(s_cols) != sorted(d_cols):
            results[name] = f"COLUMNS differ spark={s_cols} duck={d_cols}"
            continue
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        if a == b:
            td = type_diffs(sdf, rel)
            results[name] = f"OK ({len(a)} rows, {ts:.1f}s)" + (f" TYPES {td}" if td else "")
        else:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            results[name] = f"MISMATCH spark={len(a)} duck={len(b)} first diffs={diff}"
    if verbose:
        for k, v in results.items():
            print(f"{k:34s} {v}")
    return results


if __name__ == "__main__":
    from hirelens.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if not (v.startswith("OK") or v.startswith("rows-only"))]
    print("FAILED:", bad)
