"""Instants against validity windows, however long or many the windows are.

The starts and ends of all windows cut time into elementary intervals, numbered
in order. A window is a range of these numbers; it is split into at most two
pieces on each level of a binary tree over them (pieces of 1, 2, 4 ... numbers),
so a window of any length is some 2 log n rows, and what a window offers is
reduced piece by piece before intervals meet it. An instant's interval is its
count of bounds at or before it, told by one range-partitioned sort of bounds
and instants together; no day or hour is ever unrolled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary import session
from granary.operators.ordering import dense_number, running_total

INSTANT = "timestamp"


def bounds(windows: DataFrame, start: str, end: str) -> DataFrame:
    """``at, rank``: the distinct starts and first moments after the ends, numbered from 1 in time order.

    Windows hold their end itself; a missing start or end is no bound.
    """
    ends = [F.col(start).cast(INSTANT), F.col(end).cast(INSTANT) + F.expr("interval 1 microsecond")]
    at = windows.select(F.explode(F.array(*ends)).alias("at")).where("at is not null").distinct()
    return session.stage(dense_number(at, ["at"], "rank"), "window-bounds")


def ranked(windows: DataFrame, edges: DataFrame, start: str, end: str) -> DataFrame:
    """``windows`` with ``_from, _to``: the numbers of the first interval each covers and of the first after it.

    Interval n lies between bound n and the next; interval 0 comes before all of them.
    """
    count = edges.agg(F.coalesce(F.max("rank"), F.lit(0))).first()[0]  # one value
    begins = edges.select(F.col("at").alias("_start"), F.col("rank").alias("_from"))
    stops = edges.select(F.col("at").alias("_stop"), F.col("rank").alias("_to"))
    marked = windows.withColumns(
        {"_start": F.col(start).cast(INSTANT), "_stop": F.col(end).cast(INSTANT) + F.expr("interval 1 microsecond")}
    )
    placed = marked.join(begins, "_start", "left").join(stops, "_stop", "left")
    return (
        placed.withColumns({"_from": F.coalesce("_from", F.lit(0)), "_to": F.coalesce("_to", F.lit(count + 1))})
        .where("_from < _to").drop("_start", "_stop")
    )


def levels_for(edges: DataFrame) -> int:
    """Levels of the tree over intervals 0 .. number of bounds."""
    return int(edges.agg(F.coalesce(F.max("rank"), F.lit(0))).first()[0] + 1).bit_length() + 1


def _level(number: Column, level: Column) -> Column:
    return F.call_function("shiftright", number, level)


def pieces(windows: DataFrame, levels: int) -> DataFrame:
    """``windows`` (with ``_from, _to``) once for each piece ``_level, _node`` of its range."""
    level = F.col("_level")
    size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
    low, high = _level(F.col("_from") + size - 1, level), _level(F.col("_to"), level)
    cut = windows.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).withColumns(
        {"_low": low, "_high": high}
    ).where("_low < _high")
    # an odd lower end has no parent within the range, nor has an odd upper end
    ends = F.array_compact(
        F.array(
            F.when(F.col("_low") % 2 == 1, F.col("_low")),
            F.when((F.col("_high") % 2 == 1), F.col("_high") - 1),
        )
    )
    return cut.withColumn("_node", F.explode(F.array_distinct(ends))).drop("_low", "_high", "_from", "_to")


def ancestors(intervals: DataFrame, number: str, levels: int) -> DataFrame:
    """``intervals`` once for each piece ``_level, _node`` that its number may be covered by."""
    spread = intervals.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    return spread.withColumn("_node", _level(F.col(number), F.col("_level")))


def interval_of(instants: DataFrame, edges: DataFrame, at: str, name: str) -> DataFrame:
    """``instants`` with ``name``, the number of the interval that ``at`` lies in; NULL for a missing instant.

    Bounds and instants are sorted together in range slices, so an interval
    with very many instants, or one moment with very many, is spread over tasks.
    """
    columns = instants.columns
    moments = instants.where(F.col(at).isNotNull()).select(
        *columns, F.col(at).cast(INSTANT).alias("_at"), F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_bound"),
        F.xxhash64(*columns).alias("_spread"),
    )
    marks = edges.select(F.col("at").alias("_at"), F.lit(0).alias("_kind"), F.lit(1).cast("long").alias("_bound"))
    both = moments.unionByName(marks, allowMissingColumns=True)
    counted = running_total(both, [], ["_at", "_kind", "_spread"], "_bound", name).where("_kind = 1")
    none = instants.where(F.col(at).isNull()).withColumn(name, F.lit(None).cast("long"))
    return counted.select(*columns, name).unionByName(none)
