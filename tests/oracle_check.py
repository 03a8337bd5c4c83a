"""Run registered queries beside their SQL checks. Usage: oracle_check.py FOLDER [name-prefix ...]"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 6) + 0.0
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda r: [(x is not None, str(x)) for x in r]
    return [columns[i] for i in order], sorted(
        ([norm(r[i]) for i in order] for r in rows), key=key
    )


def connect(folder: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in sorted(os.listdir(folder)):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from '{folder}/{f}'")
    return con


def compare(df, con, sql):
    spark_cols, spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    duck_cols, duck_rows = rows_of([d[0] for d in cur.description], cur.fetchall())
    if spark_cols != duck_cols:
        return f"columns differ: {spark_cols} vs {duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return f"row counts differ: {len(spark_rows)} vs {len(duck_rows)}"
    bad = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    if bad:
        return f"{len(bad)} of {len(spark_rows)} rows differ; first: {str(bad[0])[:1500]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from stayspark.session import build_session

    folder, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = build_session("oracle-check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            df = run(spark, folder)
            sql = oracles.get(name)
            problem = None
            n = ""
            if sql is None:
                n = f"rows only: {df.count()}"
            else:
                problem = compare(df, con, sql)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - t:.2f}s {n} {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
