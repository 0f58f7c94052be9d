"""Run catalog queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import collections
import datetime as _dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def _spark_type(t) -> str:
    from pyspark.sql import types as T
    return {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE",
            T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN"}.get(type(t), t.simpleString())


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: _spark_type(f.dataType) for f in sdf.schema.fields}
    rel = con.sql(sql)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["why"] = f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    if s_types != d_types:
        out["ok"] = False
        out["why"] = f"types differ: {s_types} vs {d_types}"
        return out
    a = collections.Counter(rows_of(s_cols, s_rows))
    b = collections.Counter(rows_of(d_cols, d_rows))
    out["ok"] = a == b
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        out["why"] = (f"cols={sorted(s_cols)}\n  only spark: {only_s}\n  only duck: {only_d}")
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from emberflow.session import build_session
    from emberflow.plans.catalog import QUERIES
    from emberflow.plans.oracle import SQL
    if os.environ.get("PLAIN_SESSION"):
        # what a driver does: a stock session with only the partition count set
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = build_session("local[8]", 8)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    con = duck(sf_dir)
    bad = 0
    for name in sorted(SQL):
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, QUERIES[name], SQL[name], sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:800]}"}
        bad += not r["ok"]
        flag = "PASS" if r["ok"] else "FAIL"
        print(f"{flag} {name:24s} spark={r.get('spark_rows')} duck={r.get('duck_rows')} "
              f"t={r.get('spark_s')}s", flush=True)
        if not r["ok"]:
            print("   ", r["why"], flush=True)
    missing = sorted(set(QUERIES) - set(SQL))
    print("no oracle:", missing)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
