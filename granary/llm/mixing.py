"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents fall by hash into a power of two of blocks, whose order
is a seeded permutation. A source's target is met by whole passes over its
blocks and one partial pass over the first blocks of the permuted order; near
the cut, documents are taken one by one while they fit, so the words taken end
next to the target. The numbers of blocks drawn per source form the root of a
tree over the output shards: a node splits its quotas in two by multivariate
hypergeometric draws, so that every shard's quotas are exact and distributed as
if all blocks had been shuffled. A shard then owns disjoint runs of each
source's permuted blocks, and its rows are shuffled locally by a hash.

What the driver holds is one row per source. Block sums are at most 2^20 rows a
source, in Spark; decisions per document come from arithmetic on its hash.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own, ordered last; rows equal in id and text are
decided together; a source without words has target 0; texts of any length are counted whole, and a
source of few very long ones needs no more memory than another; an empty table
gives an empty result. Input columns named like an added one are replaced.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary import session
from granary.llm import text as T
from granary.llm.frames import shielded, without

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MOST_REPEATS = 2
DOCS_PER_BLOCK = 64
LEAST_BITS, MOST_BITS = 6, 20
REGION_DOCS = 256  # on either side of the cut
EXACT_UNITS = 128
GRID = 1 << 20  # most steps between 0 and the greatest sum that is tried
BROADCAST_ROWS = 100_000

ADDED = ("size", "source_size", "target", "copies")


def targets(
    sizes: list[int], weights: list[int], share: Fraction = SHARE, most: int = MOST_REPEATS
) -> list[Fraction]:
    """``share`` of all sizes by weight, none above ``most`` times its size, the excess reshared by weight."""
    given: list[Fraction | None] = [None] * len(sizes)
    left, total = set(range(len(sizes))), share * sum(sizes)
    while left:
        unit = (total - sum(x for x in given if x is not None)) / sum(weights[i] for i in left)
        full = [i for i in left if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in left:
                given[i] = unit * weights[i]
            break
        for i in full:
            given[i] = Fraction(most * sizes[i])
        left.difference_update(full)
    return [Fraction(x or 0) for x in given]


def split_quotas(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """Quotas of each shard: halve the shards again and again, drawing each half's blocks without replacement."""

    def node(held: np.ndarray, low: int, high: int) -> list[list[int]]:
        if high - low == 1:
            return [held.tolist()]
        middle = (low + high) // 2
        draw = np.random.default_rng([seed, low, high])
        wanted, rest, part = int(held.sum()) * (middle - low) // (high - low), int(held.sum()), np.zeros_like(held)
        for i, owned in enumerate(held.tolist()):
            rest -= owned
            part[i] = draw.hypergeometric(owned, rest, wanted) if wanted and owned else 0
            wanted -= int(part[i])
        return node(part, low, middle) + node(held - part, middle, high)

    return node(np.array(quotas, dtype=np.int64), 0, shards)


@dataclass
class Mix:
    """What the mix decides: one row per source, and the units taken one by one near the cuts."""

    sources: DataFrame
    picked: DataFrame
    seed: int
    shards: int
    text: str
    id_column: str
    source: str
    few_picks: bool


def _unit(text: str, id_column: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_column), F.col(text))


def _position() -> Column:
    """Place of a document's block in its source's permuted order."""
    block = F.expr("shiftrightunsigned(_unit, 64 - _bits)")
    return F.pmod(block * F.col("_step") + F.col("_start"), F.expr("shiftleft(1L, _bits)"))


def fill(words: list[int], room: int) -> list[int]:
    """Places of numbers whose sum comes near ``room``: one by one while they fit, the last ones by subset sums.

    Of two sums as near, the lower one is taken. Sums above ``GRID`` are told
    on a grid of that many steps, so memory is bounded whatever the numbers;
    then single numbers are exchanged while that brings the sum nearer.
    """
    head, tail, taken = words[:-EXACT_UNITS], words[-EXACT_UNITS:], []
    for i, n in enumerate(head):
        if 0 < n <= room:
            room -= n
            taken.append(i)
    step = -(-(room + max(tail, default=0) + 1) // GRID)
    chosen = _nearest_sum([(n + step // 2) // step for n in tail], room // step)
    if step > 1:
        chosen = _exchanged(tail, chosen, room)
    return taken + [len(head) + i for i in chosen]


def _nearest_sum(numbers: list[int], room: int) -> list[int]:
    """Places of numbers whose sum is nearest to ``room``, the lower of two as near."""
    within = (1 << (room + max(numbers, default=0) + 1)) - 1
    sums = [1]  # bit k: some of the numbers so far add up to k
    for n in numbers:
        sums.append((sums[-1] | sums[-1] << n) & within)
    below, above = sums[-1] & ((1 << (room + 1)) - 1), sums[-1] >> (room + 1)
    best = below.bit_length() - 1
    if above and (over := (above & -above).bit_length()) < room - best:
        best = room + over
    chosen = []
    for i in range(len(numbers) - 1, -1, -1):
        if not sums[i] >> best & 1:
            best -= numbers[i]
            chosen.append(i)
    return chosen


def _exchanged(numbers: list[int], chosen: list[int], room: int) -> list[int]:
    """``chosen`` after adding, leaving out or exchanging single numbers while the sum comes nearer to ``room``."""
    inside = set(chosen)
    off = room - sum(numbers[i] for i in chosen)
    while off:
        out = [(0, None), *((numbers[i], i) for i in inside)]
        into = [(0, None), *((n, i) for i, n in enumerate(numbers) if n and i not in inside)]
        best = min(((abs(off - new + old), i, j) for old, i in out for new, j in into), key=lambda found: found[0])
        if best[0] >= abs(off):
            break
        for i, change in ((best[1], -1), (best[2], 1)):
            if i is not None:
                off -= change * numbers[i]
                inside ^= {i}
    return sorted(inside, reverse=True)


def _picks(near: pd.DataFrame) -> pd.DataFrame:
    """The units of one source's region that fill the words still wanted."""
    near = near.sort_values(["_position", "_unit"], kind="stable")
    taken = near.iloc[fill(near["_words"].tolist(), max(0, int(near["_room"].iloc[0])))]
    return taken[["_source", "_unit"]]


def plan(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 7,
    text: str = "text",
    id_column: str = "doc_id",
    source: str = "source",
) -> Mix:
    """Decide the mix of ``docs``."""
    spark = docs.sparkSession
    narrow = session.stage(
        docs.select(
            F.col(source).cast("string").alias("_source"),
            F.regexp_count(T.whole(text), F.lit(T.WORD)).cast("long").alias("_words"),
            _unit(text, id_column, seed).alias("_unit"),
        ),
        "mix-sizes",
    )
    found = narrow.groupBy("_source").agg(F.sum("_words").alias("size"), F.count(F.lit(1)).alias("docs")).collect()
    found.sort(key=lambda r: (r._source is None, r._source or ""))
    sizes = [r["size"] for r in found]
    aims = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))])
    rows = []
    for r, aim in zip(found, aims):
        passes = int(aim // r["size"]) if r["size"] else 0
        bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, r.docs / DOCS_PER_BLOCK)))))
        draw = hashlib.blake2b(repr((seed, r._source)).encode(), digest_size=16).digest()
        step, start = (int.from_bytes(half, "big") % (1 << bits) for half in (draw[:8], draw[8:]))
        room = float(aim - passes * r["size"])
        rows.append((r._source, r["size"], float(aim), passes, room, bits, step | 1, start))
    # one row a source; beyond the bound Spark joins them as it sees fit
    placed = F.broadcast if len(rows) <= BROADCAST_ROWS else lambda table: table
    first = spark.createDataFrame(
        rows,
        "_source string, _size long, _target double, _passes int, _room double, _bits int, _step long, _start long",
    )
    blocks = (
        narrow.join(placed(first), narrow["_source"].eqNullSafe(first["_source"])).drop(first["_source"])
        .withColumn("_position", _position())
        .groupBy("_source", "_position")
        .agg(
            F.sum("_words").alias("words"),
            F.count(F.lit(1)).alias("docs"),
            F.first("_room").alias("_room"),
        )
    )
    # at most 2^20 blocks a source
    order = Window.partitionBy("_source").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    # whole blocks up to the cut, but for those of the last documents before it: these and the next may be picked
    summed = blocks.withColumns({"through": F.sum("words").over(order), "_docs_through": F.sum("docs").over(order)})
    fits = F.when(F.col("through") <= F.col("_room"), F.col("_docs_through"))
    summed = summed.withColumn("_docs_cut", F.coalesce(F.max(fits).over(Window.partitionBy("_source")), F.lit(0)))
    inside = (F.col("through") <= F.col("_room")) & (F.col("_docs_through") <= F.col("_docs_cut") - REGION_DOCS)
    region = ~inside & (F.col("_docs_through") - F.col("docs") < F.col("_docs_cut") + REGION_DOCS)
    cuts = {
        r._source: r
        for r in summed.groupBy("_source")
        .agg(
            F.coalesce(F.min(F.when(~inside, F.col("_position"))), F.max("_position") + 1).alias("cut"),
            F.coalesce(F.max(F.when(region, F.col("_position"))) + 1, F.max("_position") + 1).alias("end"),
            F.coalesce(F.max(F.when(inside, F.col("through"))), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(region, F.col("docs"))), F.lit(0)).alias("docs"),
        )
        .collect()
    }
    # what is picked near the cut counts as so many blocks of mean size
    spares = [max(0, int(row[4]) - cuts[row[0]].words) for row in rows]
    picks = [-(-spare * (1 << row[5]) // row[1]) if row[1] else 0 for row, spare in zip(rows, spares)]
    quotas = [row[3] * (1 << row[5]) + cuts[row[0]].cut + pick for row, pick in zip(rows, picks)]
    shares = split_quotas(quotas, shards, seed)
    table = [
        (*row, cuts[row[0]].cut, cuts[row[0]].end, pick, np.cumsum([share[i] for share in shares]).tolist())
        for i, (row, pick) in enumerate(zip(rows, picks))
    ]
    schema = first.schema.simpleString().removeprefix("struct<").removesuffix(">")
    sources = spark.createDataFrame(table, f"{schema},_cut:long,_end:long,_picks:long,_ends:array<bigint>")

    near = (
        narrow.join(placed(sources), narrow["_source"].eqNullSafe(sources["_source"])).drop(sources["_source"])
        .withColumn("_position", _position())
        .where((F.col("_position") >= F.col("_cut")) & (F.col("_position") < F.col("_end")))
        .groupBy("_source", "_position", "_unit")
        .agg(F.sum("_words").alias("_words"))
    )
    spare = spark.createDataFrame(
        [(row[0], spare) for row, spare in zip(rows, spares)], "_source string, _room long"
    )
    picked = session.stage(
        near.join(placed(spare), near["_source"].eqNullSafe(spare["_source"]))
        .drop(spare["_source"])
        .groupBy("_source")
        .applyInPandas(_picks, "_source string, _unit long"),
        "mix-picks",
    )
    few = sum(c.docs for c in cuts.values()) <= BROADCAST_ROWS
    return Mix(placed(sources), picked, seed, shards, text, id_column, source, few)


def _decided(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` with the decisions, and where the copies lie in the mix."""
    docs = without(docs, *(set(ADDED) - {mix.text, mix.id_column, mix.source}))
    sources = mix.sources.withColumnRenamed("_source", "_its_source")
    picked = mix.picked.select(F.col("_source").alias("_picked_source"), F.col("_unit").alias("_picked_unit"))
    rows = docs.withColumns(
        {
            "size": F.regexp_count(T.whole(mix.text), F.lit(T.WORD)).cast("long"),
            "_unit": _unit(mix.text, mix.id_column, mix.seed),
        }
    )
    rows = rows.join(sources, F.col(mix.source).cast("string").eqNullSafe(F.col("_its_source")))
    rows = rows.withColumn("_position", _position()).join(
        F.broadcast(picked) if mix.few_picks else picked,
        F.col("_its_source").eqNullSafe(F.col("_picked_source")) & (F.col("_unit") == F.col("_picked_unit")),
        "left",
    )
    extra = (F.col("_position") < F.col("_cut")) | F.col("_picked_unit").isNotNull()
    beyond = F.expr("((_position - _cut) * _picks) div greatest(_end - _cut, 1)")
    last = F.when(F.col("_position") < F.col("_cut"), F.col("_position")).otherwise(F.col("_cut") + beyond)
    return rows.withColumns(
        {
            "_last": last,
            "source_size": F.col("_size"),
            "target": F.col("_target"),
            "copies": F.when(F.col("size") == 0, 0).otherwise(F.col("_passes") + extra.cast("int")),
        }
    ).select(*docs.columns, *ADDED, "_unit", "_position", "_last", "_passes", "_bits", "_ends")


def _shard_of(copy: Column) -> Column:
    """The shard that owns a copy's block, told from the ends of the shards' runs of blocks."""
    inside = F.when(copy == F.col("_passes"), F.col("_last")).otherwise(F.col("_position"))
    block = copy * F.expr("shiftleft(1L, _bits)") + inside
    return F.size(F.filter("_ends", lambda end: end <= block))


@shielded
def decide(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``shards``, the shard of each copy."""
    shards = F.transform(F.sequence(F.lit(0), F.col("copies") - 1), _shard_of)
    none = F.array().cast("array<int>")
    return (
        _decided(without(docs, *({"shards"} - {mix.text, mix.id_column, mix.source})), mix)
        .withColumn("shards", F.when(F.col("copies") > 0, shards).otherwise(none))
        .drop("_unit", "_position", "_last", "_passes", "_bits", "_ends")
    )


@shielded
def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mix itself: a row per copy taken, with ``copy``, ``shard`` and a ``place`` that shuffles the shard.

    Rows are dealt out evenly by their place, itself a hash, and each task's
    rows of a shard lie in that order.
    """
    docs = without(docs, "copy", "shard", "place")
    return (
        _decided(docs, mix)
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .withColumn("shard", _shard_of(F.col("copy")))
        .withColumn("place", F.xxhash64(F.lit(mix.seed), F.col("_unit"), F.col("copy")))
        .drop("_unit", "_position", "_last", "_passes", "_bits", "_ends")
        .repartition("shard", "place")
        .sortWithinPartitions("shard", "place")
    )
