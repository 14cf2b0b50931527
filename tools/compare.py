"""Run registered queries against their SQL twins: compare.py [folder] [query ...]."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.catalog.registry import ORACLE, QUERIES  # noqa: E402
import tallyloom.catalog  # noqa: E402,F401
from tallyloom.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(v):
    if isinstance(v, dt.datetime) and v.time() == dt.time():
        return ("ts", v)
    return (type(v).__name__, v)


def as_rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def difference(spark, con, folder: str, name: str) -> str | None:
    df = QUERIES[name](spark, folder)
    got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    columns = [c[0] for c in res.description]
    want = as_rows(columns, res.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if got != want:
        extra, lost = list((got - want).elements()), list((want - got).elements())
        return f"rows {got.total()} / {want.total()}; only spark {len(extra)} {extra[:2]}; only sql {len(lost)} {lost[:2]}"
    return None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session("8"), connect(folder), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        start = time.time()
        try:
            note = difference(spark, con, folder, name) if name in ORACLE else "no SQL"
        except Exception as e:  # noqa: BLE001
            note = f"{type(e).__name__}: {str(e)[:600]}"
        bad += note is not None
        print(f"{'ok ' if note is None else 'BAD'} {name} {time.time() - start:.2f}s {note or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")


if __name__ == "__main__":
    main()
