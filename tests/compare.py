"""Compare registered queries with their SQL: ``python tests/compare.py FOLDER [NAME ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def expected(folder: str, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    result = connection.execute(sql)
    return [d[0] for d in result.description], [str(d[1]) for d in result.description], result.fetchall()


def normal(columns: list[str], types: list[str], rows: list) -> tuple[list[tuple], list[tuple]]:
    """Columns and types by name, rows as sorted text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(tuple(repr(row[i]) for i in order) for row in rows)
    return [(columns[i], types[i]) for i in order], lines


def compare(spark, folder: str, name: str, query, sql: str) -> str:
    """Empty when equal, otherwise what differs."""
    frame = query(spark, folder)
    types = [TYPES.get(kind, kind) for _, kind in frame.dtypes]
    got = normal(frame.columns, types, [tuple(r) for r in frame.collect()])
    want = normal(*expected(folder, sql))
    if got == want:
        return "" if got[1] else "no rows"
    only_got = [r for r in got[1] if r not in set(want[1])][:2]
    only_want = [r for r in want[1] if r not in set(got[1])][:2]
    return f"{got[0]} {want[0]} rows {len(got[1])}/{len(want[1])} got {only_got} want {only_want}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tokenmill.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    oracles = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            difference = compare(spark, folder, name, query, oracles[name])
        except Exception as error:  # noqa: BLE001
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(difference)
        print(f"{name:28} {time.time() - started:6.1f}s {'ok' if not difference else difference}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
