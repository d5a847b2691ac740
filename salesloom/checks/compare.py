"""Run the registered queries and their SQL checks on one data folder and compare them.

    python -m salesloom.checks.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.10g}")
    if hasattr(value, "as_tuple"):
        return float(f"{float(value):.10g}")
    if isinstance(value, int) and not isinstance(value, bool):
        return float(f"{float(value):.10g}")
    return value


def sort_key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=sort_key)


def differences(got, want, limit=3):
    (gc, gr), (wc, wr) = got, want
    if gc != wc:
        return [f"columns {gc} != {wc}"]
    out = [] if len(gr) == len(wr) else [f"rows {len(gr)} != {len(wr)}"]
    out += [f"  spark {a}\n  sql   {b}" for a, b in zip(gr, wr) if a != b][:limit]
    return out


KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def type_differences(df, con, text):
    """Columns whose type differs between the engines."""
    have = {row[0]: row[1] for row in con.execute(f"DESCRIBE {text}").fetchall()}
    return [f"type of {c}: {t} is {have.get(c)}" for c, t in df.dtypes if have.get(c) != KINDS.get(t)]


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def check(spark: SparkSession, folder: str, names=()):
    from salesloom.checks.oracle import SQL
    from salesloom.plans.registry import callables
    con, bad = connect(folder), []
    for name, query in callables().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            got = normal(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            if name not in SQL:
                print(f"rows  {name:42s} {len(got[1]):7d} {took:6.2f}s", flush=True)
                continue
            result = con.execute(SQL[name])
            want = normal([d[0] for d in result.description], result.fetchall())
            problems = differences(got, want) + type_differences(df, con, SQL[name])
        except Exception as error:  # report and go on with the other queries
            problems, took, got = [f"{type(error).__name__}: {str(error)[:1500]}"], time.time() - start, ([], [])
        print(f"{'FAIL' if problems else 'ok  '}  {name:42s} {len(got[1]):7d} {took:6.2f}s", *problems, sep="\n    " if problems else "", flush=True)
        if problems:
            bad.append(name)
    return bad


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    failed = check(session, folder, sys.argv[2:])
    print("failed:", failed)
