"""Run a registered query in Spark and its SQL in DuckDB, and report where they differ."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _key(value):
    return (value is None, str(type(value)), value if value is not None else 0)


def _rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [_key(v) for v in r])


def _same(a, b, exact):
    if isinstance(a, float) and isinstance(b, float) and not exact:
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b and type(a) is type(b)


def differences(df, connection, sql: str, exact: bool = True) -> list[str]:
    """Differences in column names, types and values; empty when the results are the same."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = dict(zip(names, (str(d[1]) for d in result.description)))
    expected = result.fetchall()
    found = []
    columns = sorted(df.columns)
    if columns != sorted(names):
        return [f"columns {columns} and {sorted(names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            found.append(f"{name} is {kind} and {kinds[name]}")
    actual = _rows(df.select(*columns).collect())
    place = {n: i for i, n in enumerate(names)}
    expected = _rows([[row[place[c]] for c in columns] for row in expected])
    if len(actual) != len(expected):
        found.append(f"{len(actual)} and {len(expected)} rows")
    for a, b in zip(actual, expected):
        if not all(_same(x, y, exact) for x, y in zip(a, b)):
            found.append(f"{dict(zip(columns, a))}\n  and {dict(zip(columns, b))}")
            break
    return found
