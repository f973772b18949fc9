"""Snapshots of operational tables, from Parquet or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def snapshot(spark: SparkSession, location: str, table: str) -> DataFrame:
    """A table exported as Parquet under ``location``."""
    return spark.read.parquet(f"{location}/{table}")


def jdbc_snapshot(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """The same table read from its database in key ranges, one task each."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .options(partitionColumn=key, lowerBound=lower, upperBound=upper, numPartitions=partitions)
        .load()
    )
