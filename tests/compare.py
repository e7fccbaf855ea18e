"""Run registered queries against their SQL on DuckDB and compare every value."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir) -> str | None:
    """None when equal, else the first difference."""
    df = fn(spark, sf_dir)
    left = normal(df.columns, [tuple(r) for r in df.collect()])
    con.execute(sql)
    right = normal([c[0] for c in con.description], con.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    kinds = [{type(v) for r in side[1] for v in r[i:i + 1] if v is not None} for side in (left, right)
             for i in range(len(left[0]))]
    n = len(left[0])
    for i in range(n):
        if kinds[i] and kinds[n + i] and kinds[i] != kinds[n + i]:
            return f"type of {left[0][i]}: {kinds[i]} != {kinds[n + i]}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if bad:
        return f"{len(bad)} rows differ, columns {left[0]}\n   spark {bad[0][0]}\n   sql   {bad[0][1]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from wattlane.catalog import ORACLES, QUERIES
    from wattlane.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    session, con = build_session(), connect(sf)
    failed = 0
    for name, fn in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(session, con, name, fn, ORACLES[name], sf)
            else:
                df = fn(session, sf)
                rows = df.collect()
                problem = None if rows else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s"
              + ("" if name in ORACLES else " (rows only)") + (f"\n   {problem}" if problem else ""), flush=True)
    print("failed:", failed)
