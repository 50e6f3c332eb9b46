"""Run registered queries and their DuckDB oracles side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows (spark/oracle), column-set match, value match.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def canon(v):
    if v is None:
        return "<null>"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return f"{float(v):.4f}"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.4f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    srows = sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
    t1 = time.time()
    if sql is None:
        return dict(name=name, spark_rows=len(srows), oracle_rows=None, cols_ok=None, values_ok=None,
                    spark_sec=round(t1 - t0, 2))
    rel = con.sql(sql)
    ocols = rel.columns
    orows_raw = rel.fetchall()
    idx = {c: i for i, c in enumerate(ocols)}
    cols_ok = sorted(ocols) == cols
    orows = sorted(tuple(canon(r[idx[c]]) for c in cols) for r in orows_raw) if cols_ok else []
    ok = cols_ok and orows == srows
    res = dict(name=name, spark_rows=len(srows), oracle_rows=len(orows_raw), cols_ok=cols_ok, values_ok=ok,
               spark_sec=round(t1 - t0, 2))
    if cols_ok and not ok:
        a, b = set(srows), set(orows)
        res["only_spark"] = sorted(a - b)[:3]
        res["only_oracle"] = sorted(b - a)[:3]
    if not cols_ok:
        res["spark_cols"], res["oracle_cols"] = cols, sorted(ocols)
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from starloom.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        try:
            r = compare(spark, con, name, qs[name], orc.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, error=repr(e)[:600])
        if r.get("values_ok") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
