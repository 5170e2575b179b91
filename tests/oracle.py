"""Run catalogue queries next to their SQL equivalents and compare the rows.

``python -m tests.oracle [sf_dir] [name ...]``
"""

from __future__ import annotations

import os
import sys
import time
import traceback
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, name, query, sql):
    """An empty string if both sides agree, else what differs."""
    df = query(spark, sf)
    got_columns, got = rows_of(df.columns, df.collect())
    if sql is None:
        return "" if got else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want_columns, want = rows_of(columns, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra, missing = got - want, want - got
        show = [str(x)[:200] for x in list(extra)[:2] + list(missing)[:2]]
        return f"{sum(got.values())} vs {sum(want.values())} rows, {sum(extra.values())} differ: {show}"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from kotomori.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark = local_session(memory=os.environ.get("CHECK_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    failed = 0
    for name in wanted:
        started = time.time()
        try:
            message = compare(spark, con, sf, name, queries()[name], oracle_sql().get(name))
        except Exception as e:
            message = f"{type(e).__name__}: {str(e)[:300]}" + traceback.format_exc()[-300:] * bool(os.environ.get("TRACE"))
        failed += bool(message)
        kind = "sql " if name in oracle_sql() else "rows"
        print(f"{'FAIL' if message else 'ok  '} {kind} {name} {time.time() - started:.1f}s {message}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
