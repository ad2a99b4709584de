"""Compare a Spark query with its SQL twin, value by value."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Spark type names as the SQL engine spells them.
TYPE_NAMES = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in names, types or values; empty if nothing does."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {row[0]: row[1] for row in described}
    found_types = {
        field.name: TYPE_NAMES.get(field.dataType.simpleString(), field.dataType.simpleString())
        for field in result.schema.fields
    }
    names = sorted(expected_types)
    if sorted(found_types) != names:
        return [f"columns {sorted(found_types)} instead of {names}"]
    found_problems = [
        f"{name} is {found_types[name]} instead of {expected_types[name]}"
        for name in names
        if found_types[name] != expected_types[name]
    ]
    order = [list(expected_types).index(name) for name in names]
    expected = Counter(
        tuple(row[i] for i in order) for row in connection.execute(sql).fetchall()
    )
    found = Counter(tuple(row) for row in result.select(*(f"`{n}`" for n in names)).collect())
    if found != expected:
        found_problems.append(
            f"{sum(found.values())} rows instead of {sum(expected.values())}; "
            f"only found: {list((found - expected).items())[:3]}; "
            f"only expected: {list((expected - found).items())[:3]}"
        )
    return found_problems
