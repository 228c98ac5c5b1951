"""Spark-vs-DuckDB comparison in the driver's style: rows, columns, value hash.

Usage: python tests/compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    canon = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(canon).encode()).hexdigest()


def _spark_type_name(dt) -> str:
    s = dt.simpleString()
    return {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "double": "DOUBLE",
    }.get(s, s.upper())


def compare(spark, con, key: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    out = {"key": key, "spark_rows": len(srows), "spark_sec": round(time.time() - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    out["duck_rows"] = len(drows)
    out["cols_match"] = sorted(scols) == sorted(dcols)
    stypes = {f.name: _spark_type_name(f.dataType) for f in df.schema.fields}
    dtypes = {c: str(t) for c, t in zip(dcols, rel.types)}
    type_diff = {c: (stypes[c], dtypes.get(c)) for c in stypes if stypes[c] != dtypes.get(c)}
    if type_diff:
        out["type_diff"] = type_diff
    out["hash_match"] = out["cols_match"] and rows_digest(scols, srows) == rows_digest(dcols, drows)
    out["status"] = "ok" if (out["hash_match"] and len(srows) == len(drows)) else "MISMATCH"
    if out["status"] != "ok":
        out["spark_cols"] = scols
        out["duck_cols"] = dcols
        if out["cols_match"]:
            so = sorted(range(len(scols)), key=lambda i: scols[i])
            do = sorted(range(len(dcols)), key=lambda i: dcols[i])
            s = sorted(repr(tuple(_norm(r[i]) for i in so)) for r in srows)
            d = sorted(repr(tuple(_norm(r[i]) for i in do)) for r in drows)
            ss, dd = set(s), set(d)
            out["only_spark"] = [x for x in s if x not in dd][:3]
            out["only_duck"] = [x for x in d if x not in ss][:3]
            out["sorted_cols"] = [scols[i] for i in so]
    return out


def main(argv: list[str]) -> int:
    import __spark_entry__ as E
    from ledgerline.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = local_session(8)
    con = duck_connection(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            r = compare(spark, con, key, qs[key], oracle.get(key), sf_dir)
        except Exception as e:  # report and continue
            r = {"key": key, "status": "ERROR", "error": repr(e)[:800]}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    print(f"done: {bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
