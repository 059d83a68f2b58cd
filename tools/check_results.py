"""Run registered queries and compare each with its SQL on the same files.

    python tools/check_results.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from vacancylake.plans.queries import registered  # noqa: E402
from vacancylake.plans.queries.analytics import TABLE_NAMES  # noqa: E402
from vacancylake.session import build_session  # noqa: E402


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else number + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("--plain", metavar="ZONE", help="a session with no settings of ours, in this time zone")
    args.add_argument("names", nargs="*")
    given = args.parse_args()
    sf_dir = f"/root/testdata/sf{given.sf}"
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    if given.plain:
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", given.plain).getOrCreate())
    else:
        spark = build_session("check", 8, spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    entries = registered()
    bad = 0
    for name in given.names or list(entries):
        query, sql = entries[name]
        start = time.time()
        try:
            df = query(spark, sf_dir)
            ours = bag(df.columns, df.collect())
            took = time.time() - start
            if sql is None:
                print(f"{name:28} rows={sum(ours.values()):7} {took:6.2f}s  no SQL", flush=True)
                continue
            start = time.time()
            result = con.execute(sql)
            names = [d[0] for d in result.description]
            theirs = bag(names, result.fetchall())
            sql_took = time.time() - start
            same = ours == theirs and sorted(names) == sorted(df.columns)
            print(f"{name:28} rows={sum(ours.values()):7} {took:6.2f}s / {sql_took:5.2f}s  {'ok' if same else 'DIFFERENT'}",
                  flush=True)
            if not same:
                bad += 1
                print("   columns", sorted(df.columns), sorted(names), sum(theirs.values()))
                print("   only here ", list((ours - theirs).items())[:3])
                print("   only there", list((theirs - ours).items())[:3])
        except Exception as error:  # noqa: BLE001 - the tool reports and goes on
            bad += 1
            print(f"{name:28} FAILED {type(error).__name__}: {str(error)[:600]}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
