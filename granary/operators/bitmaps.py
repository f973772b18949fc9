"""Exact distinct counts that roll up.

Distinct counts do not add up, bitmaps of the members do: a roll-up keeps, per
group and range of 32,768 member numbers, the set of members as a bitmap, and
any coarser count is an OR of bitmaps. Both steps combine map-side, so a group
of any size sends at most one bitmap a range and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup(df: DataFrame, member: str, groups: list[str | Column]) -> DataFrame:
    """``groups, bucket, members``: the distinct whole numbers ``member`` of each group; NULL members count nowhere."""
    number = F.col(member).cast("long")
    names = [F.col(g) if isinstance(g, str) else g for g in groups]
    return (
        df.where(F.col(member).isNotNull())
        .groupBy(*names, F.call_function("bitmap_bucket_number", number).alias("bucket"))
        .agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", number)).alias("members"))
    )


def merged(rolled: DataFrame, groups: list[str | Column]) -> DataFrame:
    """The roll-up of coarser groups, or of several roll-ups put together."""
    names = [F.col(g) if isinstance(g, str) else g for g in groups]
    return rolled.groupBy(*names, "bucket").agg(F.call_function("bitmap_or_agg", F.col("members")).alias("members"))


def distinct_count(rolled: DataFrame, groups: list[str | Column], name: str) -> DataFrame:
    """Exact number of distinct members per group."""
    together = merged(rolled, groups)
    names = [c for c in together.columns if c not in ("bucket", "members")]
    counted = F.sum(F.call_function("bitmap_count", F.col("members"))).cast("long")
    return together.groupBy(*names).agg(F.coalesce(counted, F.lit(0).cast("long")).alias(name))
