"""Compare a registered query with its oracle: rows, column names, value types and values."""

from __future__ import annotations

import decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> DuckDB type.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _cell(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, decimal.Decimal):
        raise TypeError("no decimals in results")
    return repr(value)


def _rows(names: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    found = []
    relation = connection.sql(sql)
    spark_types = {f.name: f.dataType.simpleString() for f in result.schema.fields}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    expected_types = {name: SAME_TYPE.get(kind, kind) for name, kind in spark_types.items()}
    if expected_types != duck_types:
        found.append(f"types: spark {spark_types}, oracle {duck_types}")
        if set(expected_types) != set(duck_types):
            return found
    got = _rows(result.columns, [tuple(row) for row in result.collect()])
    want = _rows(relation.columns, relation.fetchall())
    if len(got) != len(want):
        found.append(f"rows: spark {len(got)}, oracle {len(want)}")
    if got != want:
        extra = [row for row in got if row not in set(want)][:3]
        lacking = [row for row in want if row not in set(got)][:3]
        found.append(f"values: only in spark {extra}, only in oracle {lacking}")
    return found
