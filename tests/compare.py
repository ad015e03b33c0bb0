"""Run registered queries next to their SQL counterparts and compare the results."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


def canonical(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_cell(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=repr)


def compare(df, con, sql: str) -> str:
    """Empty string if both sides agree, else what differs."""
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want = canonical([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} / {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1])
           if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(bad)} of {len(want[1])} rows differ, e.g. {bad[0]}" if bad else ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from marquee.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session("8")
    con = database(sf_dir)
    oracles, wanted = entry.oracle_sql(), sys.argv[1:]
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                res = compare(fn(spark, sf_dir), con, oracles[name])
            else:
                n = fn(spark, sf_dir).count()
                res = "" if n else "no rows"
        except Exception as exc:  # report and go on with the next query
            res = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += bool(res)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if res else 'ok  '} {kind:4} {time.time() - start:6.1f}s {name} {res}", flush=True)
    print(f"{bad} failures; {len(oracles)} SQL checks; without query: {set(oracles) - set(entry.queries())}")
    sys.exit(bool(bad))
