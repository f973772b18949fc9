"""Sharding: longest-processing-time scheduling of groups of equal texts.

A group is all rows with one text (told by a 64-bit hash of it; a collision
would only keep two texts together). Groups larger than a 4096th of all bytes
are scheduled one by one, so there are fewer than 4096 of them; the rest are
first bundled by hash into at most 32,768 units. The units, sorted by size, go
to the least loaded shard through a heap. That list, at most 36,863 entries at
any input size, is all the driver sees, and what is broadcast.

Rows are numbered within their shard by hash slices: one count per shard and
slice gives each slice's first number, so neither a hot text nor a shard is
ever sorted in one task.

Defined results: a null text counts as empty (size 1, checksum 0); repeated
rows each get a slot; ids may be null or repeat; a text of any length is one
size; groups of one size go in order of their hash, equal loads to the lower shard; an empty table gives an empty
result. Input columns named like an added one are replaced.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm import text as T
from granary.llm.frames import shielded, without

HEAVY = 4096
BUNDLES = 32_768
ROWS_PER_SLICE = 1024
MOST_SLICES = 8192


def least_loaded(units: list[tuple], shards: int) -> list[int]:
    """Shard of each unit ``(size, key...)``: largest first, each to the least loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    given = [0] * len(units)
    for place in sorted(range(len(units)), key=lambda i: (-units[i][0], *units[i][1:])):
        load, shard = heapq.heappop(heap)
        given[place] = shard
        heapq.heappush(heap, (load + units[place][0], shard))
    return given


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``size``, ``text_crc32`` and the group key."""
    whole = T.whole(text)
    return docs.withColumns(
        {
            "size": F.octet_length(whole).cast("long") + 1,
            "text_crc32": F.crc32(whole.cast("binary")),
            "_group": F.xxhash64(whole),
        }
    )


@shielded
def shard(docs: DataFrame, shards: int = 8, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in a shard)."""
    spark = docs.sparkSession
    rows = keyed(without(docs, *({"size", "text_crc32", "shard", "slot"} - {text, id_column})), text)

    groups = rows.groupBy("_group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    whole_size = rows.agg(F.sum("size")).first()[0] or 0
    heavy = F.col("bytes") > whole_size // HEAVY
    units = (
        groups.groupBy(
            F.when(heavy, F.col("_group")).alias("heavy"),
            F.when(~heavy, F.pmod("_group", F.lit(BUNDLES))).alias("bundle"),
        )
        .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        .collect()
    )
    places = least_loaded([(u.bytes, u.heavy is None, u.heavy or 0, u.bundle or 0) for u in units], shards)
    heavy_shard = [(u.heavy, s) for u, s in zip(units, places) if u.heavy is not None]
    bundle_shard = [(u.bundle, s) for u, s in zip(units, places) if u.heavy is None]
    slices = min(MOST_SLICES, max(1, -(-sum(u.rows for u in units) // (shards * ROWS_PER_SLICE))))

    placed = (
        rows.withColumn("_bundle", F.pmod("_group", F.lit(BUNDLES)))
        .join(F.broadcast(spark.createDataFrame(heavy_shard, "_group long, _heavy_shard int")), "_group", "left")
        .join(F.broadcast(spark.createDataFrame(bundle_shard, "_bundle long, _bundle_shard int")), "_bundle", "left")
        .withColumn("shard", F.coalesce("_heavy_shard", "_bundle_shard"))
        .withColumn("_slice", F.pmod(F.xxhash64("_group", id_column), F.lit(slices)).cast("int"))
        .drop("_bundle", "_heavy_shard", "_bundle_shard")
    )
    # at most shards x MOST_SLICES rows, whatever the input
    counts = placed.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("shard", "_slice").orderBy("_group", id_column)
    return (
        placed.withColumn("_place", F.row_number().over(within).cast("long"))
        .join(F.broadcast(first), ["shard", "_slice"])
        .withColumn("slot", F.col("_first") + F.col("_place") - 1)
        .drop("_group", "_slice", "_place", "_first")
    )
