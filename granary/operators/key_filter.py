"""Dropping rows that meet none of a set of keys, before they are shuffled.

Each wanted key sets one bit by its hash. The bits lie in words of 64, at most
1,048,576 of them however many keys there are, so they can be sent to every
task. A row whose bit is not set meets no wanted key; the others may or may not,
and a join or an aggregate has to follow. More keys than bits make the filter
let more rows through, never fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 64
BITS = WORD_BITS << 20


def _place(on: list[str]) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(BITS))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % WORD_BITS).cast("int"))


def may_meet(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows that may have a key of ``wanted``, NULL being a key like any other; none that has one is lost."""
    kinds = [{name: kind for name, kind in df.dtypes if name in on} for df in (rows, wanted)]
    if kinds[0] != kinds[1]:
        return rows  # equal values of different types have different hashes
    words = (
        wanted.select(_place(on).alias("_place"))
        .groupBy(F.expr(f"_place div {WORD_BITS}").alias("_word"))
        .agg(F.bit_or(_bit(F.col("_place"))).alias("_bits"))
    )
    placed = rows.withColumn("_place", _place(on)).withColumn("_word", F.expr(f"_place div {WORD_BITS}"))
    met = placed.join(F.broadcast(words), "_word").where(F.col("_bits").bitwiseAND(_bit(F.col("_place"))) != 0)
    return met.select(*rows.columns)
