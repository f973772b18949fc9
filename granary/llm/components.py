"""Connected components of a link table, by alternating large and small stars.

Each round is joins and grouped minima over links; a round's links are written
to the shared folder, so a lost executor costs one round at most. Hubs are
skewed join keys, which AQE splits; minima combine before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary import session


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of a link; ``root`` is the smallest node it reaches."""
    links = session.stage(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    seen = None
    while True:
        both = links.union(links.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select("v", "m").union(lower.select("u", "m"))
        links = session.stage(small.toDF("a", "b").distinct(), "links")
        mark = tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if mark == seen:
            break
        seen = mark
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
