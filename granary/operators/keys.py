"""Row positions within files and across a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.session import stage


def file_positions(records: DataFrame) -> DataFrame:
    """``source_row`` within each file and ``bronze_id`` over the whole load.

    Input rows carry ``_file, _block, _seq``, taken at the scan, where ``_seq``
    counts up by one within a split. They are staged first: how Spark packs
    splits into tasks may differ between passes, so both passes must read the
    same tags. Counting then gives one row per split, and prefix sums over
    those rows place each split in its file and each file in the load. The
    rows themselves are neither sorted nor shuffled while the table of splits
    is small; its real size on disk decides whether it is broadcast. The sum
    over the load runs in one task, over one short row per split: some 800,000
    rows at 100 TB.
    """
    staged = stage(records, "bronze-rows")
    splits = staged.groupBy("source_file", "_file", "_block").agg(
        F.count("*").alias("_rows"), F.min("_seq").alias("_first")
    )
    earlier = Window.orderBy("source_file", "_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    earlier_in_file = (
        Window.partitionBy("source_file").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = splits.select(
        "_file",
        "_block",
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_load_offset"),
        F.coalesce(F.sum("_rows").over(earlier_in_file), F.lit(0)).alias("_file_offset"),
    )
    position = F.col("_seq") - F.col("_first") + 1
    return staged.join(stage(placed, "bronze-splits"), ["_file", "_block"]).select(
        (F.col("_load_offset") + position).alias("bronze_id"),
        (F.col("_file_offset") + position).alias("source_row"),
        *[c for c in staged.columns if c not in ("_file", "_block", "_seq")],
    )
