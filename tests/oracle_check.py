"""Run the registered queries and their SQL side by side.

``python tests/oracle_check.py [folder] [query ...]``
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def rows_of(names: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, db, query, sql: str, folder: str) -> tuple[bool, str]:
    began = time.perf_counter()
    frame = query(spark, folder)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    middle = time.perf_counter()
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    seconds = f"{middle - began:.1f}s / {time.perf_counter() - middle:.1f}s"
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} vs {sorted(names)}"
    if got == want:
        return True, f"{len(got)} rows, {seconds}"
    lost, new = [r for r in want if r not in set(got)], [r for r in got if r not in set(want)]
    return False, f"{len(got)} vs {len(want)} rows, {len(new)} differ; {new[:3]} vs {lost[:3]}"


def main() -> int:
    import __spark_entry__ as entry
    from velorank.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("oracle-check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = connect(folder), 0
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            good, note = compare(spark, db, query, sqls[name], folder)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not good
        print("ok  " if good else "FAIL", name, note, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
