"""Run registered queries beside their SQL on the same Parquet tables.

    python check.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from larkspan.registry import load_all
from larkspan.session import local_session
from larkspan.tables import SCHEMAS


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("null",)
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()))
    if isinstance(v, float):
        return ("float", v + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return ("time", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("list", tuple(canon(x) for x in v))
    return (type(v).__name__, v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(canon(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, q, sf):
    t0 = time.time()
    df = q(spark, sf)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - t0
    if q.oracle is None:
        return ("rows", f"{len(got)} rows", spent)
    t1 = time.time()
    res = con.execute(q.oracle)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    sql_spent = time.time() - t1
    if sorted(names) != sorted(df.columns):
        return ("FAIL", f"columns {sorted(df.columns)} != {sorted(names)}", spent)
    a, b = rows(df.columns, got), rows(names, want)
    if len(a) != len(b):
        only_a = [x for x in a if x not in set(b)][:2]
        only_b = [x for x in b if x not in set(a)][:2]
        return ("FAIL", f"{len(a)} rows != {len(b)}: spark {only_a} sql {only_b}", spent)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return ("FAIL", f"{len(bad)}/{len(a)} rows differ, e.g. {sorted(df.columns)}\n   spark {bad[0][0]}\n   sql   {bad[0][1]}", spent)
    return ("ok" if a else "EMPTY", f"{len(a)} rows sql {sql_spent:.1f}s", spent)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--module")
    args = ap.parse_args()
    registry = load_all()
    spark = local_session()
    con = duckdb.connect()
    for t in SCHEMAS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    failed = 0
    for name, q in registry.items():
        if args.names and name not in args.names:
            continue
        if args.module and q.build.__module__.rsplit(".", 1)[1] not in args.module.split(","):
            continue
        try:
            state, note, spent = compare(spark, con, q, args.sf)
        except Exception as e:  # report and go on with the next query
            state, note, spent = "ERROR", str(e)[:700], 0.0
        failed += state in ("FAIL", "ERROR", "EMPTY")
        print(f"{state:6} {spent:6.2f}s {name}: {note}", flush=True)
    print("failed", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
