"""Compares registered queries with their oracle SQL. Also runs as a script:

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return f"{value:.6f}"
    return value


def normalise(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(table, key=repr)


def compare(frame, con, sql: str) -> str:
    """Empty text when the results agree, else what differs."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    expected = answer.fetchall()
    rows = [tuple(row) for row in frame.collect()]
    if frame.columns != names:
        return f"columns {frame.columns} / {names}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows / {len(expected)} expected"
    ours, theirs = normalise(names, rows), normalise(names, expected)
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}\n   ours   {a}\n   oracle {b}"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tradeloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        extra={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.log.level": "ERROR",
        },
    )
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in sql:
                verdict = compare(frame, con, sql[name]) or "ok"
            else:
                verdict = f"rows only: {len(frame.collect())}"
        except Exception as error:  # report and go on
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:45s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
