"""Compare registered queries with their SQL in DuckDB.

    python tools/check.py [--sf DIR] [--show] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import importlib
import os
import sys
import time
import traceback

import duckdb
import numpy as np
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def plain(value):
    """A comparable form: floats to DIGITS (default 9) digits, everything nested to tuples."""
    if isinstance(value, (float, np.floating)):
        digits = os.environ.get("DIGITS", "9")
        return None if value != value else float(f"{float(value):.{digits}g}") + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    return value


def kind(name: str) -> str:
    name = name.lower()
    if name in ("integer", "int", "bigint", "smallint", "tinyint", "hugeint", "long"):
        return "int"
    if name.startswith("decimal"):
        return "decimal"
    return {"varchar": "string", "float": "double"}.get(name, name)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, entry, name, sf):
    start = time.time()
    df = entry.queries()[name](spark, sf)
    got = df.collect()
    spent = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows-only {len(got)} rows", spent
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    kinds = {d[0]: kind(str(d[1])) for d in res.description}
    want = res.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} vs {sorted(names)}", spent
    mine = {c: kind(k) for c, k in df.dtypes}
    odd = {c: (mine[c], kinds[c]) for c in names if mine[c] != kinds[c]}
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"FAIL rows {len(a)} vs {len(b)}", spent
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"FAIL {len(bad)} of {len(a)} rows differ, columns {sorted(names)}, e.g.\n   {str(bad[0][0])[:600]}\n   {str(bad[0][1])[:600]}", spent
    return f"ok {len(a)} rows" + (f"  EMPTY" if not a else "") + (f"  KINDS {odd}" if odd else ""), spent


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    entry = importlib.import_module("__spark_entry__")
    bad = 0
    for name in entry.queries():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        try:
            verdict, spent = compare(spark, con, entry, name, args.sf)
        except Exception as problem:  # noqa: BLE001
            verdict, spent = "ERROR " + str(problem)[:1500], 0.0
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += verdict.startswith(("FAIL", "ERROR"))
        print(f"{name:38s} {spent:6.2f}s  {verdict}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
