"""Duplicate handling: keep the first row, collapse copies, report conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key along ``order``.

    The ``= 1`` filter lets Spark keep one row per key and task before the
    shuffle (WindowGroupLimit), so a key that holds a third of all rows sends
    no more than one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def dedup_least(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key along ``order``, as the least row; ties go by the other columns.

    An aggregate with map-side combine: rows are grouped by key alone instead of
    sorted by key and order. All columns must be orderable and NULLs come first.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    least = F.min(F.struct(*order, *rest)).alias("_least")
    chosen = df.groupBy(*keys).agg(least)
    return chosen.select(*[F.col(c) if c in keys else F.col(f"_least.{c}") for c in df.columns])


def dedup_exact(df: DataFrame) -> DataFrame:
    """Collapse rows that agree in every column."""
    return df.dropDuplicates()


def _versions(df: DataFrame, key: str) -> DataFrame:
    """Lowest and highest row per key; they differ when the key has conflicts."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(F.col(key).alias("_key")).agg(F.min(row).alias("_low"), F.max(row).alias("_high"))


def conflicting_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys whose rows are not all the same.

    Rows are compared by two 64-bit digests of all columns, whose minima and
    maxima aggregate by hash; NULL is told from an empty value by its flag.
    """
    cells = [cell for c in df.columns for cell in (F.col(c), F.col(c).isNull())]
    digests = {f"_{n}": F.xxhash64(F.lit(n), *cells) for n in (1, 2)}
    ends = [end(name).alias(f"{name}_{label}") for name in digests for label, end in (("low", F.min), ("high", F.max))]
    versions = df.select(F.col(key).alias("_key"), *[d.alias(name) for name, d in digests.items()]).groupBy("_key")
    return versions.agg(*ends).filter("_1_low <> _1_high or _2_low <> _2_high").select(F.col("_key").alias(key))


def dedup_exact_or_reject(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with exact copies collapsed, and the keys that conflict.

    One shuffle with map-side minimum and maximum, instead of a distinct over
    all columns followed by a count per key.
    """
    versions = _versions(df, key)
    agree = F.col("_low").eqNullSafe(F.col("_high"))
    return (
        versions.filter(agree).select("_low.*"),
        versions.filter(~agree).select(F.col("_key").alias(key)),
    )
