"""Batches on disk: idempotent writes, staging checks and atomic publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.fingerprint import file_digests, manifest_diff
from granary.operators.quality import union_all
from granary.plans import commits
from granary.session import exists


class BatchError(ValueError):
    """A batch on disk does not agree with its source."""


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a write to this path has finished."""
    return exists(spark, f"{path}/_SUCCESS")


def rebuild(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace a table."""
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.parquet(path)


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Write a batch table unless it is already complete.

    A retry finds finished tables and leaves them alone; a table whose write
    was cut short has no completion marker and is written again.
    """
    if not is_complete(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def by_month(fact: DataFrame, day: str, sort_by: list[str]) -> DataFrame:
    """Rows gathered by month for a write partitioned by ``month``.

    Rebalancing keeps files near the advisory size: a month with very many
    rows is split over several tasks and small months share one. Sorting in
    each task lets readers skip row groups by key.
    """
    key = F.col(day)
    month = (F.year(key) * 100 + F.month(key)) if dict(fact.dtypes)[day] == "date" else F.floor(key / 100)
    return fact.withColumn("month", month.cast("int")).hint("rebalance", "month").sortWithinPartitions("month", *sort_by)


def stage_typed(df: DataFrame, types: dict[str, str], path: str) -> DataFrame:
    """Write a table in contract types; an existing copy must have as many rows."""
    typed = df.select([F.col(name).cast(kind).alias(name) for name, kind in types.items()])
    existed = is_complete(df.sparkSession, path)
    staged = write_once(typed, path)
    if existed and staged.count() != df.count():
        raise BatchError(f"row count differs from the staged copy: {path}")
    return staged


def archive_raw(spark: SparkSession, folder: str, names: tuple[str, ...], batch: str, path: str) -> DataFrame:
    """Original files, byte for byte, one row each."""
    files = (
        spark.read.format("binaryFile")
        .load(folder)
        .select(
            F.lit(batch).alias("batch"),
            F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
            "length",
            F.sha2("content", 256).alias("sha256"),
            "content",
        )
        .filter(F.col("name").isin(*names))
    )
    return write_once(files, path)


def import_state(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Per file name: new, missing, same or conflict between two folders."""
    def manifest(folder: str) -> DataFrame:
        return file_digests(spark, folder).select("name", F.col("sha256").alias("digest"))

    return manifest_diff(manifest(target), manifest(source))


def switch_view(spark: SparkSession, view: str, batch_tables: dict[str, str], select: str) -> None:
    """Publish a batch by replacing one view.

    ``batch_tables`` maps catalog table names to the paths of the batch;
    ``select`` reads those tables. Earlier batches stay where they are.
    """
    for table, path in batch_tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {select}")


def switch_pointer(spark: SparkSession, root: str, batch: str, tables: dict[str, str] | None = None) -> commits.Commit:
    """Publish without a catalog: a commit that makes this batch, and its tables, the current one.

    A batch that is current already is not committed again; earlier ones stay readable by their version.
    """

    def build(parent: commits.Commit):
        return None if parent.version and parent.batch == batch else (tables or {}, parent.notes)

    return commits.publish(spark, root, batch, build)


def current_batch(spark: SparkSession, root: str) -> str | None:
    """Name of the published batch, None before the first publication."""
    state = commits.current(spark, root)
    return state.batch if state.version else None


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Columns of several one-row tables in one row."""
    stacked = rows[0]
    for row in rows[1:]:
        stacked = stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """``table_name, rows`` of several tables."""
    return union_all(
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in layers.items()
    )


def batch_summary(batch: str, sources: dict[str, DataFrame], fact: DataFrame) -> DataFrame:
    """Source counts, sales lines and net revenue of a batch as one small table."""
    sales = fact.agg(F.count("*").alias("rows"), F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue"))
    counted = row_counts(sources).withColumn("net_revenue", F.lit(None).cast("decimal(18,2)"))
    lines = sales.select(F.lit("fact_sales").alias("table_name"), "rows", "net_revenue")
    return counted.unionByName(lines).select(F.lit(batch).alias("batch"), "table_name", "rows", "net_revenue")


def export(df: DataFrame, path: str, kind: str) -> None:
    """Sharded export as ``csv`` (with header) or ``json`` (JSON Lines)."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown export format: {kind}")
