"""Registration of the corpus queries, apart from the warehouse ones."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from granary.session import tune

Query = Callable[[SparkSession, str], DataFrame]

# documents may be long, so few go to a Python worker at once
ARROW_ROWS = "512"

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the DuckDB SQL of the same rows."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
            return function(spark, folder.rstrip("/"))

        if name in QUERIES:
            raise KeyError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register
