"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def normalize(v):
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(normalize(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(normalize(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "binary": "BLOB"}


def type_mismatches(df, con, sql):
    """Columns whose Spark type does not map to the oracle's DuckDB type."""
    st = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [(c, st.get(c), dt.get(c)) for c in sorted(set(st) | set(dt))
            if SPARK_TO_DUCK.get(st.get(c), (st.get(c) or "").upper()) != dt.get(c)]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, sf_dir, names=None, verbose=True):
    from rivulet.plans.registry import all_queries
    con = duck(sf_dir)
    results = {}
    for name, q in sorted(all_queries().items()):
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = q.fn(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", str(e)[:400])
            if verbose:
                print(f"{name:32s} SPARK ERROR {str(e)[:400]}")
            continue
        ts = time.time() - t0
        if not q.sql:
            results[name] = ("no-oracle", len(srows))
            if verbose:
                print(f"{name:32s} rows={len(srows):8d} spark={ts:6.2f}s (no oracle)")
            continue
        try:
            cur = con.execute(q.sql)
            dcols = [c[0] for c in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("sql-error", str(e)[:400])
            if verbose:
                print(f"{name:32s} SQL ERROR {str(e)[:400]}")
            continue
        sc, sr = canon(scols, srows)
        dc, dr = canon(dcols, drows)
        types = type_mismatches(df, con, q.sql)
        ok = sc == dc and sr == dr and not types
        results[name] = ("ok" if ok else "MISMATCH", len(srows), len(drows))
        if verbose:
            print(f"{name:32s} rows={len(srows):8d}/{len(drows):8d} spark={ts:6.2f}s "
                  f"{'ok' if ok else 'MISMATCH'}" + ("" if sc == dc else f" cols {sc} vs {dc}")
                  + (f" types {types}" if types else ""))
            if not ok and sc == dc:
                a, b = set(sr), set(dr)
                print("   spark-only:", list(a - b)[:3])
                print("   oracle-only:", list(b - a)[:3])
    return results


if __name__ == "__main__":
    from rivulet.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = check(spark, sf, set(sys.argv[2:]) or None)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "no-oracle")]
    print("FAILED:", bad if bad else "none")
