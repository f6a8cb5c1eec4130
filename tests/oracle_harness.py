"""Run a registered query in Spark and its DuckDB twin; compare results.

Mirrors the driver's correctness gate: row count, column names (sorted)
and an order-insensitive comparison of values (floats rounded).
"""

from __future__ import annotations

import datetime as _dt
import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


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
            return "nan"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return [cols[i] for i in order], out


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    sql = oracle_sql().get(name)
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    sc, sr = _rows(s_cols, s_rows)
    dc, dr = _rows(d_cols, d_rows)
    if sc != dc:
        res["status"] = "columns"
        res["detail"] = {"spark_only": sorted(set(sc) - set(dc)), "duck_only": sorted(set(dc) - set(sc))}
    elif len(sr) != len(dr):
        res["status"] = "rowcount"
    elif sr != dr:
        res["status"] = "values"
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        res["detail"] = {"columns": sc, "spark": diff_s, "duck": diff_d}
    else:
        res["status"] = "ok"
    return res


def main(argv):
    sys.path.insert(0, ".")
    from tillstack.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    names = argv[2:]
    spark = local_session(8)
    from __spark_entry__ import queries
    con = duck(sf_dir)
    bad = 0
    for name in names or list(queries()):
        try:
            r = compare(spark, name, sf_dir, con)
        except Exception as e:  # report and keep going
            r = {"query": name, "status": "error", "detail": repr(e)[:600]}
        if r["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main(sys.argv) else 0)
