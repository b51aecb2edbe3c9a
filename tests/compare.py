"""Run registered queries against their SQL: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cell(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(cell(v) for v in value) + "]"
    return f"{type(value).__name__}:{value}"


def canonical(names: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


# How the two engines name the same type.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def type_differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[tuple]:
    described = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return [(name, kind, described.get(name)) for name, kind in df.dtypes if TYPES.get(kind, kind) != described.get(name)]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def spark_result(df) -> tuple[list[str], list[tuple]]:
    return canonical(df.columns, [tuple(row) for row in df.collect()])


def oracle_result(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    return canonical([column[0] for column in cursor.description], cursor.fetchall())


def main() -> None:
    import __spark_entry__ as registered
    from tidemark.session import local_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = local_session("compare")
    connection, oracles, failed = connect(sf_dir), registered.oracle_sql(), []
    for name, run in registered.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            columns, rows = spark_result(df)
            seconds = time.time() - start
            if name not in oracles:
                print(f"rows {name} {len(rows)} {seconds:.2f}s {rows[:6]}")
                continue
            expected_columns, expected = oracle_result(connection, oracles[name])
            same = columns == expected_columns and rows == expected
            print(f"{'ok  ' if same else 'BAD '} {name} {len(rows)}/{len(expected)} {seconds:.2f}s {rows[:1] if same else ''}")
            other_types = type_differences(df, connection, oracles[name])
            if other_types:
                failed.append(name)
                print("    types", other_types)
            if not same:
                failed.append(name)
                print("   ", columns, expected_columns)
                print("    only spark", [r for r in rows if r not in set(expected)][:3])
                print("    only sql  ", [r for r in expected if r not in set(rows)][:3])
        except Exception as error:
            failed.append(name)
            print("FAIL", name, str(error)[:1500])
            if chosen:
                traceback.print_exc()
    print("failed:", failed)


if __name__ == "__main__":
    main()
