"""Run registered Spark queries and their DuckDB oracles; compare results.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if hasattr(v, "item") and not isinstance(v, (bytes, bytearray)):
        try:
            v = v.item()
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return str(v)


def rows_digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir, sql):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def compare(spark, sf_dir, name, fn, sql, verbose=True):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    d_cols, d_rows = duck(sf_dir, sql)
    sn, sh, sl = rows_digest(s_cols, s_rows)
    dn, dh, dl = rows_digest(d_cols, d_rows)
    ok = sorted(s_cols) == sorted(d_cols) and sn == dn and sh == dh
    if verbose:
        print(f"{'OK ' if ok else 'BAD'} {name:18s} rows={sn}/{dn} spark={t1 - t0:.1f}s", flush=True)
        if not ok:
            if sorted(s_cols) != sorted(d_cols):
                print("   cols", sorted(s_cols), sorted(d_cols))
            a, b = set(sl), set(dl)
            for x in list(a - b)[:3]:
                print("   spark only:", x[:300])
            for x in list(b - a)[:3]:
                print("   duck  only:", x[:300])
    return ok


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", os.environ.get("COMPARE_TZ", "UTC"))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.oracle_sql())
    spark = session()
    qs, ors = E.queries(), E.oracle_sql()
    bad = []
    for n in names:
        try:
            if not compare(spark, sf_dir, n, qs[n], ors[n]):
                bad.append(n)
        except Exception as e:  # noqa: BLE001
            print(f"ERR {n}: {type(e).__name__}: {str(e)[:800]}", flush=True)
            bad.append(n)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
