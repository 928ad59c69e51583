"""Compares registered queries with their SQL counterparts in DuckDB.

Usage: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gapweave.plans.catalog import QUERIES  # noqa: E402
from gapweave.plans.oracles import ORACLES  # noqa: E402
from gapweave.plans.views import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(r[i]) for i in order) for r in rows)


def check(spark, con, name: str, sf_dir: str) -> tuple[str, int, list]:
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return "rows only", len(got), []
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return "columns differ", len(got), [sorted(names), sorted(df.columns)]
    if got != want:
        missing = sorted(set(want) - set(got))[:2]
        extra = sorted(set(got) - set(want))[:2]
        return "values differ", len(got), [len(want), missing, extra]
    return "ok", len(got), []


if __name__ == "__main__":
    from gapweave.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    session = build_session("compare")
    session.sparkContext.setLogLevel("OFF")
    database = connect(sf)
    bad = 0
    for q in chosen:
        start = time.time()
        try:
            status, n, detail = check(session, database, q, sf)
        except Exception as error:  # noqa: BLE001
            status, n, detail = "error", -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += status not in ("ok", "rows only")
        print(f"{q:32s} {status:14s} {n:7d} rows {time.time() - start:6.1f}s", *detail, flush=True)
    print("failed:", bad)
