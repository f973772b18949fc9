"""Keyed state kept as small deltas, one folder per micro-batch.

An update-mode query sends only the keys that changed. Each micro-batch is
written under its own id, so a repeated batch overwrites itself, and nothing
older is rewritten. Reading takes the newest delta per key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def delta_writer(path: str, split: Callable[[DataFrame], dict[str, DataFrame]] | None = None):
    """A foreachBatch function that writes each batch's rows under ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if split is None:
            batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            return
        batch.persist()  # read once per output
        try:
            for name, rows in split(batch).items():
                rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def read_deltas(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def current(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest row per key."""
    deltas = read_deltas(spark, path)
    rest = [c for c in deltas.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*rest), "batch").alias("_row")
    return deltas.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def compact(spark: SparkSession, path: str, keys: list[str], out: str) -> DataFrame:
    """Fold all deltas into one table."""
    current(spark, path, keys).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def run_available(writer, checkpoint: str) -> None:
    """Process what is there now, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
