"""Compare registered queries with their DuckDB twins, value by value."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def connect(folder: str = SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("f", 0.0 if v == 0 else v)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v if v is None else str(v)


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(con, sql, df) -> str:
    """Empty text when the results are equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = bag(names, cur.fetchall())
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got == want:
        return ""
    less, more = want - got, got - want
    return (
        f"rows {sum(got.values())} and {sum(want.values())}; missing {sum(less.values())}, "
        f"e.g. {next(iter(less), None)}; extra {sum(more.values())}, e.g. {next(iter(more), None)}"
    )


if __name__ == "__main__":
    import __spark_entry__ as entry
    from lakeloom.session import build_session

    spark = build_session("oracle")
    con = connect()
    sql = entry.oracle_sql()
    wanted = sys.argv[1:]
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, SF)
            note = compare(con, sql[name], df) if name in sql else f"rows only: {df.count()}"
        except Exception as e:  # report and go on
            note = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        if note and not note.startswith("rows only"):
            bad += 1
        print(f"{name:28s} {time.time() - start:6.2f}s {note or 'ok'}", flush=True)
    print("bad:", bad)
