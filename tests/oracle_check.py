"""Runs registered queries in Spark and their oracle SQL in DuckDB on the same
parquet tables and compares row count, column names/types and values
(order-insensitive, columns sorted by name).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize() if v == v else v
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def kind_spark(dt_):
    n = dt_.simpleString()
    if n.startswith("decimal"):
        return n.replace(" ", "")
    return {"bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8",
            "string": "str", "double": "float64", "float": "float32", "boolean": "bool",
            "date": "date", "timestamp_ntz": "ts", "timestamp": "tstz"}.get(n, n)


def kind_duck(t):
    t = str(t).upper()
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return {"BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8",
            "VARCHAR": "str", "DOUBLE": "float64", "FLOAT": "float32", "BOOLEAN": "bool",
            "DATE": "date", "TIMESTAMP": "ts", "TIMESTAMP WITH TIME ZONE": "tstz",
            "HUGEINT": "int128"}.get(t, t.lower())


def compare(spark, sf_dir, names=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            s_cols = sdf.columns
            s_types = [kind_spark(f.dataType) for f in sdf.schema.fields]
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:400])
            if verbose:
                print(f"{name:24s} SPARK-ERROR {str(e)[:400]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("NO-ORACLE", len(s_rows))
            if verbose:
                print(f"{name:24s} rows={len(s_rows):6d} no oracle  {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            d_cols = [c[0] for c in cur.description]
            d_types = [kind_duck(c[1]) for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL-ERROR", str(e)[:400])
            if verbose:
                print(f"{name:24s} SQL-ERROR {str(e)[:400]}")
            continue
        problems = []
        if sorted(s_cols) != sorted(d_cols):
            problems.append(f"columns spark={s_cols} duck={d_cols}")
        else:
            st = dict(zip(s_cols, s_types))
            dtp = dict(zip(d_cols, d_types))
            diff = {c: (st[c], dtp[c]) for c in s_cols if st[c] != dtp[c]}
            if diff:
                problems.append(f"types {diff}")
            order = sorted(s_cols)
            si = [s_cols.index(c) for c in order]
            di = [d_cols.index(c) for c in order]
            key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
            a = sorted((tuple(norm(r[i]) for i in si) for r in s_rows), key=key)
            b = sorted((tuple(norm(r[i]) for i in di) for r in d_rows), key=key)
            if len(a) != len(b):
                problems.append(f"rows spark={len(a)} duck={len(b)}")
            elif a != b:
                bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
                problems.append(f"values differ e.g. {bad}")
        status = "OK" if not problems else "MISMATCH"
        results[name] = (status, problems)
        if verbose:
            print(f"{name:24s} rows={len(s_rows):6d} {status} {ts:.1f}s {'; '.join(problems)[:600]}")
    return results


if __name__ == "__main__":
    from strata.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO-ORACLE")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
