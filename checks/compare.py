"""Run registered queries and compare them with their SQL.

    python -m checks.compare [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import decimal
import glob
import os
import sys
import tempfile
import time
import traceback

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES


def duck(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(x):
    if isinstance(x, decimal.Decimal):
        return format(x.normalize(), "f") if x else "0"
    if isinstance(x, float):
        return f"{x:.9g}"
    return str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](spark, sf)
    got = df.collect()
    took = time.time() - start
    if name not in ORACLE:
        return bool(got), f"{len(got)} rows, no SQL, {took:.1f}s"
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} but SQL has {sorted(columns)}"
    a, b = rows_of(df.columns, [tuple(r) for r in got]), rows_of(columns, want.fetchall())
    if a == b:
        return bool(a), f"{len(a)} rows equal, {took:.1f}s"
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return False, f"{len(a)} rows, SQL {len(b)}; only here {only_a}; only SQL {only_b}"[:1500]


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("queries", nargs="*")
    args = parser.parse_args()
    from riftlog.session import build_session

    spark = build_session("checks", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="checks-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(args.sf), 0
    for name in args.queries or QUERIES:
        try:
            ok, note = compare(spark, con, name, args.sf)
        except Exception:
            ok, note = False, traceback.format_exc(limit=-6)[-2500:]
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
