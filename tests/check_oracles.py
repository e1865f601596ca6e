"""Runs registered queries next to their SQL counterparts and compares the rows.

    python tests/check_oracles.py [table folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def types_match(df, connection, sql) -> list[str]:
    """Columns whose types differ, by the names both engines use."""
    names = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN"}
    described = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{c}: {t} / {described.get(c)}" for c, t in df.dtypes if names.get(t) != described.get(c)]


def main() -> int:
    from conftest import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, connection = build_session(), connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    unknown = set(oracles) - set(queries)
    failures = len(unknown)
    if unknown:
        print("SQL without a query:", unknown)
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            columns, rows = spark_rows(df)
        except Exception as error:  # report and go on with the next query
            failures += 1
            print(f"{name}: FAILED {type(error).__name__} {str(error)[:600]}")
            continue
        took = time.time() - start
        if name not in oracles:
            print(f"{name}: {len(rows)} rows, no SQL, {took:.1f}s")
            continue
        start = time.time()
        try:
            expected_columns, expected = sql_rows(connection, oracles[name])
            types = types_match(df, connection, oracles[name])
        except Exception as error:
            failures += 1
            print(f"{name}: SQL FAILED {str(error)[:600]}")
            continue
        same = columns == expected_columns and rows == expected and not types
        failures += not same
        print(f"{name}: {'ok' if same else 'DIFFERS'} {len(rows)}/{len(expected)} rows, "
              f"{took:.1f}s / {time.time() - start:.1f}s", types or "")
        if not same:
            print("   columns", columns, expected_columns)
            left, right = set(rows), set(expected)
            print("   only spark", sorted(left - right, key=repr)[:3])
            print("   only sql  ", sorted(right - left, key=repr)[:3])
    spark.stop()
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
