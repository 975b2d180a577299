"""Compare every registered query with its SQL on DuckDB. Usage: check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, int):
        return f"{v:.9g}" if abs(v) < 10**9 else str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir) -> tuple[bool, str, float]:
    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(got)} rows, no SQL", took
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(set(names) ^ set(df.columns))}", took
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return True, f"{len(a)} rows", took
    extra = [x for x in a if x not in set(b)][:2]
    lacking = [x for x in b if x not in set(a)][:2]
    return False, f"{len(a)} vs {len(b)} rows\n  spark only {extra}\n  sql only {lacking}", took


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con, bad = session(), duck(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        try:
            ok, note, took = compare(spark, con, name, sf_dir)
        except Exception as e:
            ok, note, took = False, f"{type(e).__name__}: {str(e)[:600]}", 0.0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {took:.2f}s {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
