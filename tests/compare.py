"""Runs registered queries beside their SQL and compares whole results.

    python tests/compare.py [folder] [query ...]
"""

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from noteloom.plans.oracles import ORACLES  # noqa: E402
from noteloom.plans.queries import QUERIES  # noqa: E402


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def expected(connection, name: str):
    result = connection.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    return sorted(columns), _bag(columns, result.fetchall())


def actual(spark, folder: str, name: str):
    df = QUERIES[name](spark, folder)
    return sorted(df.columns), _bag(df.columns, [tuple(r) for r in df.collect()])


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def difference(left: Counter, right: Counter) -> str:
    only_left, only_right = left - right, right - left
    if not only_left and not only_right:
        return ""
    show = lambda bag: [tuple(v[:120] for v in row) for row in list(bag)[:3]]
    return (
        f"{sum(only_left.values())} rows only in Spark, e.g. {show(only_left)}\n"
        f"{sum(only_right.values())} rows only in SQL, e.g. {show(only_right)}"
    )


def main() -> int:
    from noteloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, connection, bad = local_session(8), oracle(folder), 0
    for name in names:
        try:
            began = time.time()
            columns, rows = actual(spark, folder, name)
            took = time.time() - began
            if name not in ORACLES:
                print(f"{name}: {sum(rows.values())} rows, no SQL")
                continue
            other_columns, other_rows = expected(connection, name)
            problem = difference(rows, other_rows)
            if columns != other_columns:
                problem = f"columns {columns} / {other_columns}\n{problem}"
        except Exception as error:
            problem, rows, took = f"{type(error).__name__}: {str(error)[:1500]}", Counter(), 0
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {name}: {sum(rows.values())} rows, {took:.1f} s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
