"""Run registered queries next to their SQL oracles and compare whole results.

``python -m tests.oracle_check [folder] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, bool):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = [tuple(plain(r[i]) for i in order) for r in rows]
    return names, sorted(data, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cur = con.execute(sql)
    return normal([d[0] for d in cur.description], cur.fetchall())


def difference(got, want) -> str | None:
    """None when equal, else a short account of the first difference."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, expected {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"row {a} != {b}"[:1500]
    return None


def main(argv: list[str]) -> int:
    from siltstone.queries import ORACLES, QUERIES
    from siltstone.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con, bad = local_session("oracle-check"), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            got = spark_rows(QUERIES[name](spark, folder))
            note = f"{len(got[1])} rows"
            if name in ORACLES:
                problem = difference(got, oracle_rows(con, ORACLES[name]))
            else:
                problem, note = None, note + " (no oracle)"
            if not got[1]:
                note += " EMPTY"
        except Exception as exc:  # report and go on with the next query
            problem, note = f"{type(exc).__name__}: {str(exc)[:1200]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {note} {time.time() - start:.1f}s", flush=True)
        if problem:
            print("     ", problem, flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
