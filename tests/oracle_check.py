"""Runs registered queries beside their DuckDB counterparts: ``python tests/oracle_check.py [sf] [name …]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value) -> str:
    if isinstance(value, float):
        return repr(value + 0.0)
    return repr(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """NULL when both agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    theirs = rows_of(names, cur.fetchall())
    if mine == theirs:
        return None
    a, b = set(mine), set(theirs)
    return f"{len(mine)} and {len(theirs)} rows; {sorted(names)}; only here {sorted(a - b)[:3]}; only there {sorted(b - a)[:3]}"


if __name__ == "__main__":
    from postmill.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    session = build_session("local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for query_name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem = compare(session, connection, query_name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok ' if problem is None else 'BAD'} {query_name} {time.time() - start:.2f}s {problem or ''}", flush=True)
