"""Runs queries on Spark and their SQL on DuckDB and compares whole results.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )


def differences(spark_rows, duck_rows, tolerance=0.0):
    bad = []
    for a, b in zip(spark_rows, duck_rows):
        for x, y in zip(a, b):
            if x == y:
                continue
            if isinstance(x, (int, float)) and isinstance(y, (int, float)) and not isinstance(x, bool):
                if abs(x - y) <= tolerance:
                    continue
            bad.append((a, b))
            break
    return bad


def compare(spark, con, query, sql, folder):
    df = query(spark, folder)
    columns, rows = normal(df.columns, df.collect())
    if sql is None:
        return f"rows only: {len(rows)}", True
    con.execute(sql)
    other, expected = normal([c[0] for c in con.description], con.fetchall())
    if columns != other:
        return f"columns {columns} != {other}", False
    if len(rows) != len(expected):
        return f"rows {len(rows)} != {len(expected)}", False
    bad = differences(rows, expected)
    if not bad:
        return f"ok {len(rows)}", True
    loose = differences(rows, expected, 2e-6)
    return f"{len(bad)} differ ({len(loose)} by more than 2e-6) of {len(rows)}: {(loose or bad)[0]}", False


def main():
    from __spark_entry__ import oracle_sql, queries

    from panelwatch.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(8), duck(folder)
    todo, sql, failed = queries(), oracle_sql(), []
    for name in args.names or todo:
        start = time.time()
        try:
            text, good = compare(spark, con, todo[name], sql.get(name), folder)
        except Exception as e:  # report and go on
            text, good = f"ERROR {type(e).__name__}: {str(e)[:600]}", False
        if not good:
            failed.append(name)
        print(f"{'  ' if good else '!!'} {name}: {text} [{time.time() - start:.1f}s]", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
