"""Run registered queries next to their SQL checks: python tests/check_queries.py DIR [key ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from cartwheel.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return (2, float(v))
    return (3, str(v)[:10] if type(v).__name__ in ("datetime", "date") else str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, key):
    """(same, rows, detail) of one query against its check; None when there is no check."""
    df = entry.queries()[key](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(key)
    if sql is None:
        return None, len(got), "no check"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, len(got), f"columns {sorted(df.columns)} / {sorted(names)}"
    if got == want:
        return True, len(got), ""
    bad = next(((a, b) for a, b in zip(got, want) if a != b), "lengths")
    return False, len(got), f"{len(got)} / {len(want)} rows, first difference {bad}"


if __name__ == "__main__":
    folder, keys = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(folder)
    for key in keys or entry.queries():
        begin = time.time()
        try:
            same, n, detail = compare(spark, con, folder, key)
        except Exception as e:  # noqa: BLE001 - the report goes on with the next key
            same, n, detail = False, -1, f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{key:26s} {str(same):5s} rows={n} {time.time() - begin:.1f}s {detail}", flush=True)
