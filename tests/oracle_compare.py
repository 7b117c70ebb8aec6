"""Run a registered Spark query and its DuckDB oracle on the same parquet tables
and compare row count, column names and order-insensitive values."""

from __future__ import annotations

import math
import sys
import time

import os

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:26]
    return v


def rows_of(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, names=None) -> dict:
    sys.path.insert(0, ".")
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        sdf = fn(spark, sf_dir)
        srows = [r.asDict() for r in sdf.collect()]
        scols = sorted(sdf.columns)
        t1 = time.time()
        if name not in sql:
            report[name] = {"rows": len(srows), "oracle": None, "sec": round(t1 - t0, 2)}
            continue
        try:
            res = con.execute(sql[name])
        except Exception as exc:  # noqa: BLE001
            report[name] = {"error": str(exc)[:400]}
            continue
        dcols = [d[0] for d in res.description]
        drows = [dict(zip(dcols, r)) for r in res.fetchall()]
        ok_cols = scols == sorted(dcols)
        entry = {"rows": len(srows), "oracle_rows": len(drows), "cols": ok_cols, "sec": round(t1 - t0, 2)}
        if ok_cols:
            a, b = rows_of(srows, scols), rows_of(drows, scols)
            entry["match"] = a == b
            if a != b:
                sa, sb = set(a), set(b)
                entry["only_spark"] = [list(x) for x in list(sa - sb)[:3]]
                entry["only_oracle"] = [list(x) for x in list(sb - sa)[:3]]
        else:
            entry["spark_cols"], entry["oracle_cols"] = scols, sorted(dcols)
        report[name] = entry
    return report


if __name__ == "__main__":
    from ingestry.session import build_local_session

    spark = build_local_session()
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    rep = compare(spark, sf, sys.argv[2:] or None)
    for k, v in rep.items():
        print("CMP", k, v, flush=True)
