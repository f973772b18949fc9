"""Totals and numbers along one global order, without a single-task sort.

A window over a hot key, or over no key, sorts all its rows in one task. Here
Spark range-partitions the rows on the full order instead, so that even one
key spreads over many tasks, and the slices are stitched together by prefix
sums over one row per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.session import stage

_POSITION_BITS = 33  # layout of monotonically_increasing_id


def ordered_slices(df: DataFrame, order: list[str], label: str = "slices") -> DataFrame:
    """Rows tagged with ``_slice`` and ``_at`` that follow the given order.

    The tags depend on how the rows were partitioned, so the result is written
    to the shared folder: a lost executor cannot change them between passes.
    """
    tagged = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    return stage(tagged, label).withColumn("_slice", F.shiftright("_at", _POSITION_BITS))


def _before(value: str, order: str, keys: list[str] | None = None) -> Column:
    """Sum of ``value`` over the earlier rows."""
    window = Window.partitionBy(*(keys or [])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def dense_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows 1..n along a total order, like an unpartitioned ROW_NUMBER.

    One range shuffle; the offsets hold one row per slice, so there are never
    more of them than shuffle partitions and they are safe to broadcast.
    """
    slices = ordered_slices(df, order, name)
    first = slices.groupBy("_slice").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    offsets = first.select("_slice", "_first", _before("_rows", "_slice").alias("_offset"))
    numbered = slices.join(F.broadcast(offsets), "_slice")
    return numbered.withColumn(name, F.col("_at") - F.col("_first") + F.col("_offset") + 1).select(*df.columns, name)


def _same_keys(keys: list[str], left: str, right: str) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Running sum of ``value`` per key along a total order.

    The rows are cut into range slices on key and order, so a key of any size
    spreads over many tasks; each slice adds what the key summed up to before.
    """
    slices = ordered_slices(df, [*keys, *order], name)
    sums = slices.groupBy("_slice", *keys).agg(F.sum(value).alias("_sum"))
    carry = sums.select("_slice", *keys, _before("_sum", "_slice", keys).alias("_carry"))
    inside = Window.partitionBy("_slice", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    matched = slices.alias("l").join(
        carry.alias("r"),
        (F.col("l._slice") == F.col("r._slice")) & _same_keys(keys, "l", "r"),
    )
    return (
        matched.select("l.*", "r._carry")
        .withColumn(name, F.sum(value).over(inside) + F.col("_carry"))
        .select(*df.columns, name)
    )
