"""Runs the registered queries beside their DuckDB SQL: ``python tests/oracle.py [sf] [name...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def compare(spark, name: str, f, sql: str, d: str) -> str:
    """An empty string if both give the same rows under the same column names, else what differs."""
    import duckdb

    con = duckdb.connect()
    for t in os.listdir(d):
        con.execute(f"create view {t.split('.')[0]} as select * from '{d}/{t}'")
    df = f(spark, d)
    cols = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} and {sorted(rel.columns)}"
    at = [rel.columns.index(c) for c in cols]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    if ours == theirs:
        return ""
    a, b = set(map(repr, ours)), set(map(repr, theirs))
    return f"{len(ours)} and {len(theirs)} rows; only ours {len(a - b)}: {sorted(a - b)[:2]}; only SQL {len(b - a)}: {sorted(b - a)[:2]}"


def main() -> int:
    import __spark_entry__ as entry
    from lawweave.session import session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    spark = session(f"local[{os.environ.get('BENCH_CPUS', '8')}]", 8)
    spark.sparkContext.setLogLevel("OFF")
    q, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names or sql:
        t = time.time()
        try:
            said = compare(spark, n, q[n], sql[n], f"/root/testdata/sf{sf}")
        except Exception as e:
            said = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(said)
        print(f"{n}: {'ok' if not said else said[:1200]} ({time.time() - t:.1f} s)", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
