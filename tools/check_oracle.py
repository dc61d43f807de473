"""Compare registered queries with their SQL in DuckDB.

    python tools/check_oracle.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    out = [tuple(canonical(r[k]) for k in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def duck_connection(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder, name, fn, sql):
    start = time.time()
    df = fn(spark, folder)
    columns, rows = df.columns, [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if sql is None:
        return f"rows-only {len(rows)} rows {spent:.1f}s", True
    start = time.time()
    cur = con.execute(sql)
    want_columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    duck = time.time() - start
    got_c, got = sorted_rows(columns, rows)
    want_c, want = sorted_rows(want_columns, want)
    note = f"{len(rows)} rows, spark {spent:.1f}s, duckdb {duck:.1f}s"
    if got_c != want_c:
        return f"COLUMNS {got_c} vs {want_c}", False
    if got != want:
        a, b = set(got), set(want)
        extra, lacking = sorted(a - b, key=repr)[:3], sorted(b - a, key=repr)[:3]
        return (
            f"DIFFER {note}; duckdb has {len(want)} rows; only spark {len(a - b)}: {str(extra)[:700]}; "
            f"only duckdb {len(b - a)}: {str(lacking)[:700]}",
            False,
        )
    return note, True


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    from tidings.catalog import SPARK, SQL
    from tidings.session import build_session

    spark = build_session(
        "check",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.driver.maxResultSize": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(args.sf)
    bad = 0
    for name, fn in SPARK.items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        try:
            note, ok = compare(spark, con, args.sf, name, fn, SQL.get(name))
        except Exception as exc:  # report and go on with the next query
            note, ok = f"ERROR {type(exc).__name__}: {str(exc)[:1500]}", False
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{bad} failed")
    spark.stop()
    return bool(bad)


if __name__ == "__main__":
    raise SystemExit(main())
