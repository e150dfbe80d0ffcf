"""Run every registered query in Spark and its SQL in DuckDB; compare like the driver does.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
       "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def kind(type_name: str) -> str:
    t = type_name.lower()
    for key, k in (("decimal", "decimal"), ("timestamp", "timestamp"), ("char", "string"), ("string", "string"),
                   ("double", "float"), ("float", "float"), ("bool", "bool"), ("date", "date"), ("int", "int")):
        if key in t:
            return k
    return t


def multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in RAW:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def registered():
    from itemrollup.queries import QUERIES

    return QUERIES


def compare(spark, sf_dir, names=None):
    from itemrollup.queries import QUERIES

    con = duck(sf_dir)
    results = {}
    for name, (fn, sql) in QUERIES.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
            t1 = time.time()
            rel = con.sql(sql)
            o_cols = rel.columns
            o_types = dict(zip(o_cols, [str(t) for t in rel.types]))
            o_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("ERROR", str(e)[:400])
            print(f"{name:32s} ERROR {str(e)[:300]}", flush=True)
            continue
        ok_cols = sorted(s_cols) == sorted(o_cols)
        s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        type_diff = {c: (s_types[c], o_types.get(c)) for c in s_cols
                     if c in o_types and kind(s_types[c]) != kind(o_types[c])}
        if type_diff:
            print(f"   TYPE {name}: {type_diff}")
        ms, mo = multiset(s_cols, s_rows), multiset(o_cols, o_rows)
        ok = ok_cols and ms == mo
        results[name] = ("OK" if ok else "DIFF", len(s_rows), len(o_rows))
        print(f"{name:32s} {'OK  ' if ok else 'DIFF'} spark={len(s_rows)} oracle={len(o_rows)} "
              f"cols={'ok' if ok_cols else (sorted(set(s_cols) ^ set(o_cols)))} {t1 - t0:.1f}s", flush=True)
        if not ok and ok_cols:
            only_s = list((ms - mo).elements())[:3]
            only_o = list((mo - ms).elements())[:3]
            keys = sorted(s_cols)
            print("   spark-only:", [dict(zip(keys, r)) for r in only_s][:2])
            print("   oracle-only:", [dict(zip(keys, r)) for r in only_o][:2])
    return results


if __name__ == "__main__":
    from itemrollup.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] != "OK"]
    print(f"{len(res) - len(bad)}/{len(res)} OK; bad: {bad}")
