"""Registration of queries next to their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from granary.catalog.model_sql import with_model
from granary.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the model tables by name."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(tune(spark), folder.rstrip("/"))

        if name in QUERIES:
            raise KeyError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_model(sql)
        return run

    return register
