"""Compare every registered query with its SQL, in both engines' own types.

    python tests/check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from keelson.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows) -> list[tuple]:
    """Rows as sortable text, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(f"{type(r[i]).__name__}:{r[i]}" for i in order) for r in rows)


def compare(df, con, sql) -> str:
    """Empty when both give the same rows, else what differs."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} against {sorted(relation.columns)}"
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    theirs = canonical(relation.columns, relation.fetchall())
    if mine == theirs:
        return ""
    only_mine = [r for r in mine if r not in set(theirs)]
    only_theirs = [r for r in theirs if r not in set(mine)]
    return (
        f"{len(mine)} rows against {len(theirs)};"
        f" first only here {only_mine[:1]}, first only there {only_theirs[:1]}"
    )


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    queries = entry.queries()
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = compare(queries[name](spark, sf_dir), con, oracles[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{name:24s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("no SQL:", sorted(set(queries) - set(oracles)), "no query:", sorted(set(oracles) - set(queries)))
    return bad


if __name__ == "__main__":
    sys.exit(main())
