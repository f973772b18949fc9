"""Bronze layer: raw text columns with lineage."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.contracts import BRONZE_METADATA, LANDING_FILES, OPERATIONAL_TABLES, ORDER_FIELDS
from granary.operators.keys import file_positions
from granary.sources import tables
from granary.sources.files import landing_records


def conform(df: DataFrame, fields: list[str]) -> DataFrame:
    """Exactly the declared fields as text; missing ones NULL, others dropped."""
    return df.select(
        [(F.col(name) if name in df.columns else F.lit(None)).cast("string").alias(name) for name in fields]
    )


def load_time() -> datetime:
    """One timestamp per load, taken once on the driver."""
    return datetime.now(timezone.utc)


def customer_orders(
    spark: SparkSession, landing: str, extracted_at: datetime | None = None, quoted_newlines: bool = True
) -> DataFrame:
    """All allowed landing files as numbered Bronze rows."""
    records = landing_records(spark, landing, LANDING_FILES, ORDER_FIELDS, quoted_newlines)
    numbered = file_positions(records)
    return numbered.withColumn("extracted_at", F.lit(extracted_at or load_time())).select(
        *BRONZE_METADATA, *ORDER_FIELDS
    )


def load(spark: SparkSession, landing: str, out: str, quoted_newlines: bool = True) -> DataFrame:
    """Full reload of the Bronze table, partitioned by file."""
    customer_orders(spark, landing, quoted_newlines=quoted_newlines).write.mode("overwrite").partitionBy("source_file").parquet(out)
    return spark.read.parquet(out)


def with_lineage(df: DataFrame, source: str, extracted_at: datetime | str) -> DataFrame:
    """Extraction time and source on every row of a snapshot."""
    return df.withColumn("_extract_ts", F.lit(extracted_at).cast("timestamp_ntz")).withColumn("_source", F.lit(source))


def operational_snapshots(spark: SparkSession, location: str, extracted_at: datetime) -> dict[str, DataFrame]:
    """Bronze copies of all operational tables found as Parquet exports."""
    return {
        f"bronze_{name}": with_lineage(tables.snapshot(spark, location, source), source, extracted_at)
        for name, source in OPERATIONAL_TABLES.items()
    }
