"""Run a query and its SQL twin and compare them row by row.

Usage: python tests/compare.py [sf_dir] [name pattern ...]
"""

from __future__ import annotations

import os
import re
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return repr(v)
    return f"{type(v).__name__}:{v!r}"


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_names, want = _table(names, cur.fetchall())
    got_names, got = _table(spark_df.columns, spark_df.collect())
    if got_names != want_names:
        return f"columns {got_names} vs {want_names}"
    if got != want:
        only_got, only_want = got - want, want - got
        return (
            f"{sum(got.values())} vs {sum(want.values())} rows, {sum(only_got.values())} differ; "
            f"got {list(only_got)[:2]} want {list(only_want)[:2]}"
        )
    if not got:
        return "no rows"
    return None


if __name__ == "__main__":
    import __spark_entry__ as e
    from opinara.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    session = local_session(cores="8")
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    twins = e.oracle_sql()
    bad = 0
    for name, fn in e.queries().items():
        if parts and not any(re.search(p, name) for p in parts):
            continue
        start = time.time()
        try:
            if name in twins:
                diff = differences(fn(session, sf), con, twins[name])
                note = "ok" if diff is None else f"DIFF {diff}"
            else:
                note = f"rows {len(fn(session, sf).collect())}"
        except Exception as exc:  # noqa: BLE001
            note = f"ERROR {str(exc)[:1500]}"
        bad += note.startswith(("DIFF", "ERROR"))
        print(f"{time.time() - start:7.2f}s {name}: {note}", flush=True)
    print(f"{bad} bad")
