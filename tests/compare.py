"""Compare a Spark result with DuckDB's answer to the check SQL."""

from __future__ import annotations

from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Spark type -> DuckDB type that counts as the same
SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "date": "DATE",
    "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _type_matches(spark_type: str, duck_type: str) -> bool:
    if spark_type.startswith("decimal") and duck_type.startswith("DECIMAL"):
        precision, scale = spark_type.removeprefix("decimal(").rstrip(")").split(",")
        duck_precision, duck_scale = duck_type.removeprefix("DECIMAL(").rstrip(")").split(",")
        # money is compared in full; wider totals differ in how wide the engines make them
        return duck_scale.strip() == scale and ("18" not in (precision, duck_precision) or precision == duck_precision)
    return SAME_TYPE.get(spark_type) == duck_type


def _value(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, Decimal):
        return str(value)
    return value


def differences(frame, connection, sql: str) -> list[str]:
    """What differs, empty when names, types and the bag of rows agree."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    duck_types = {row[0]: row[1] for row in described}
    spark_types = dict(frame.dtypes)
    if set(duck_types) != set(spark_types):
        return [f"columns: spark {sorted(spark_types)} duckdb {sorted(duck_types)}"]
    found = [
        f"type of {name}: spark {spark_types[name]} duckdb {duck_types[name]}"
        for name in sorted(spark_types)
        if not _type_matches(spark_types[name], duck_types[name])
    ]
    names = sorted(spark_types)
    duck_names = [row[0] for row in described]
    expected = Counter(
        tuple(_value(dict(zip(duck_names, row))[name]) for name in names)
        for row in connection.execute(sql).fetchall()
    )
    actual = Counter(tuple(_value(row[name]) for name in names) for row in frame.collect())
    if actual != expected:
        missing, extra = list((expected - actual).items())[:3], list((actual - expected).items())[:3]
        found.append(
            f"rows: spark {sum(actual.values())} duckdb {sum(expected.values())}; only duckdb {missing}; only spark {extra}"
        )
    return found
