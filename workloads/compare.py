"""Compare every query with its SQL twin: names, row counts and values."""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal

import duckdb

from workloads.oracle import ORACLE
from workloads.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, bool) or value is None:
        return str(value)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str, float]:
    """Whether both sides agree, a note, and the seconds Spark took."""
    start = time.perf_counter()
    frame = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in frame.collect()]
    seconds = time.perf_counter() - start
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(names)}", seconds
    a, b = _rows(frame.columns, got), _rows(names, want)
    if a != b:
        extra, lacking = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        return False, f"{len(a)} vs {len(b)} rows; only Spark {extra}; only SQL {lacking}", seconds
    return True, f"{len(a)} rows", seconds


if __name__ == "__main__":
    from rosterlake.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session, con = local_session(8), connect(sf)
    failed = []
    for query_name in sys.argv[2:] or QUERIES:
        try:
            ok, note, took = compare(session, con, query_name, sf)
        except Exception as exc:  # noqa: BLE001 - report and go on with the next query
            ok, note, took = False, f"{type(exc).__name__}: {str(exc)[:600]}", 0.0
        if not ok:
            failed.append(query_name)
        print(f"{'ok  ' if ok else 'FAIL'} {query_name:26s} {took:6.2f}s  {note}", flush=True)
    print("failed:", failed)
