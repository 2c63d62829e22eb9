"""Runs the registered queries and their SQL side by side.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, Decimal):
        return str(v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return str(sorted((str(k), _value(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return str([_value(x) for x in v])
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, query, sql):
    """None when equal, else a text that says where they differ; and the row count."""
    df = query(spark, folder)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return None, len(got), df
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got), df
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got), df
    for a, b in zip(got, want):
        if a != b:
            return f"\n   spark {str(a)[:1500]}\n   sql   {str(b)[:1500]}", len(got), df
    return None, len(got), df


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from sparkdesk.plans import all_oracles, all_queries
    from sparkdesk.session import get_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, oracles = all_queries(), all_oracles()
    bad = []
    for name in argv[1:] or queries:
        start = time.time()
        try:
            diff, count, _ = compare(spark, con, folder, queries[name], oracles.get(name))
        except Exception as e:  # noqa: BLE001 - report and go on
            diff, count = f"{type(e).__name__}: {str(e)[:700]}", -1
        if diff:
            bad.append(name)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if diff else 'ok  '} {name} [{kind}] rows={count} {time.time() - start:.1f}s {diff or ''}", flush=True)
    print(f"{len(bad)} failed: {bad}")


if __name__ == "__main__":
    main(sys.argv[1:])
