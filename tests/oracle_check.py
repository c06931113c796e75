"""Run registered queries against their DuckDB oracle (like the driver's check).

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: rows, schema and value-hash agreement.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def table_hash(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    import __spark_entry__ as se
    if os.environ.get("PLAIN"):
        # a session with Spark's defaults, as an outside caller might pass
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.ui.enabled", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from trailfeat.session import local_session
        spark = local_session(os.environ.get("TEST_CORES", "8"))
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, orc = se.queries(), se.oracle_sql()
    ok = 0
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SPARK-ERROR {str(e).splitlines()[0][:150]}")
            continue
        dt = time.time() - t0
        if k not in orc:
            print(f"{k:28s} rows={len(rows)} (no oracle) {dt:.1f}s")
            continue
        try:
            res = con.execute(orc[k])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SQL-ERROR {str(e).splitlines()[0][:200]}")
            continue
        same_cols = sorted(cols) == sorted(ocols)
        h1, h2 = table_hash(rows, cols), table_hash(orows, ocols)
        good = same_cols and len(rows) == len(orows) and h1 == h2
        ok += good
        print(f"{k:28s} {'OK ' if good else 'BAD'} rows={len(rows)}/{len(orows)} "
              f"cols={'=' if same_cols else sorted(set(cols) ^ set(ocols))} {dt:.1f}s")
        if not good and same_cols and os.environ.get("DIFF"):
            order = sorted(cols)
            a = sorted(tuple(_norm(r[cols.index(c)]) for c in order) for r in rows)
            b = sorted(tuple(_norm(r[ocols.index(c)]) for c in order) for r in orows)
            sa, sb = set(a), set(b)
            print("   cols:", order)
            for r in [r for r in a if r not in sb][:4]:
                print("   spark :", r)
            for r in [r for r in b if r not in sa][:4]:
                print("   oracle:", r)
    print(f"matched {ok}/{len(keys or qs)}")


if __name__ == "__main__":
    main()
