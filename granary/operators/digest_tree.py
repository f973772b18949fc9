"""Finding the rows that differ between two copies of a table, by a tree of digests.

The rows of a table fall into ranges by a hash of their key. A range's digest is
free of order: how many rows it has and the sums of two of their hashes. Sixteen
ranges make a node of the next level, up to one digest for the whole table. The
levels are stored beside the table, so two copies are compared from the top down:
only children of nodes that differ are compared, and only rows in ranges that
differ at last are joined. A larger table gets more levels, so a range has few
rows at any size and a change takes few others along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import exists, stage

FANOUT = 16
LEVELS = 4  # at least: 16^4 = 65,536 ranges at the bottom
DEEPEST = 10  # ranges are cut from as many digits of the hash
RANGE_ROWS = 64  # at most, on average

_DIGEST = ("rows", "sum_1", "sum_2")


def _range(keys: list[str], levels: int) -> Column:
    digits = F.pmod(F.xxhash64(*keys), F.lit(FANOUT**DEEPEST))
    return F.shiftright(digits, 4 * (DEEPEST - levels))  # the first digits, so a parent's number is a child's without its last


def _levels(rows: int) -> int:
    levels = LEVELS
    while levels < DEEPEST and rows > RANGE_ROWS * FANOUT**levels:
        levels += 1
    return levels


def depth(spark: SparkSession, path: str) -> int:
    """The lowest level of a stored tree."""
    return next(level for level in range(DEEPEST, -1, -1) if exists(spark, f"{path}/level={level}"))


def _row(columns: list[str], seed: int) -> Column:
    # NULL is told from any value by its flag
    return F.xxhash64(F.lit(seed), *[cell for c in columns for cell in (F.col(c), F.col(c).isNull())]).cast("decimal(20,0)")


def write_tree(df: DataFrame, keys: list[str], path: str) -> None:
    """Store the digests of all levels under ``path``; one pass over the table after its rows are counted."""
    columns, levels = sorted(df.columns), _levels(df.count())
    lowest = df.groupBy(_range(keys, levels).alias("node")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(_row(columns, n)).cast("decimal(38,0)").alias(f"sum_{n}") for n in (1, 2)]
    )
    lowest.write.parquet(f"{path}/level={levels}")
    for level in range(levels - 1, -1, -1):
        below = df.sparkSession.read.schema(lowest.schema).parquet(f"{path}/level={level + 1}")
        above = below.groupBy(F.expr(f"node div {FANOUT}").alias("node")).agg(
            F.sum("rows").alias("rows"), *[F.sum(f"sum_{n}").cast("decimal(38,0)").alias(f"sum_{n}") for n in (1, 2)]
        )
        if level < LEVELS:
            above = above.coalesce(max(1, FANOUT ** (level - 3)))
        above.write.parquet(f"{path}/level={level}")


def _apart(spark: SparkSession, left: str, right: str) -> tuple[DataFrame, int]:
    """``node`` of the ranges that differ between two stored trees, and the level, the lowest that both have."""
    lowest, apart = min(depth(spark, left), depth(spark, right)), None
    for level in range(lowest + 1):
        sides = [
            spark.read.schema("node bigint, rows bigint, sum_1 decimal(38,0), sum_2 decimal(38,0)").parquet(f"{path}/level={level}")
            .select("node", F.struct(*_DIGEST).alias(name))
            for path, name in ((left, "l"), (right, "r"))
        ]
        if apart is not None:
            above = apart.withColumnRenamed("node", "_above")
            sides = [side.join(above, F.expr(f"node div {FANOUT}") == F.col("_above"), "left_semi") for side in sides]
        apart = sides[0].join(sides[1], "node", "full").where(~F.col("l").eqNullSafe(F.col("r"))).select("node")
    return apart, lowest


def differing_ranges(spark: SparkSession, left: str, right: str) -> list[int]:
    """Ranges whose digests differ between two stored trees, found from the top down."""
    return sorted(row.node for row in _apart(spark, left, right)[0].collect())


def differences(left: DataFrame, right: DataFrame, keys: list[str], left_tree: str, right_tree: str) -> DataFrame:
    """``keys, state``: missing (only left), new (only right) or changed, for each key whose rows differ.

    Rows in ranges that agree are dropped at the scan and take part in no join
    while the ranges that differ are few enough to be sent to every task.
    """
    spark = left.sparkSession
    apart, levels = _apart(spark, left_tree, right_tree)
    ranges = stage(apart.withColumnRenamed("node", "_range"), "differing-ranges")
    columns = sorted(left.columns)

    def side(df: DataFrame, name: str) -> DataFrame:
        inside = df.withColumn("_range", _range(keys, levels)).join(ranges, "_range", "left_semi")
        sums = [F.sum(_row(columns, n)).alias(f"sum_{n}") for n in (1, 2)]
        return inside.groupBy(*keys).agg(F.struct(F.count(F.lit(1)), *sums).alias(name))

    l, r = side(left, "_l").alias("l"), side(right, "_r").alias("r")  # noqa: E741
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    met = l.join(r, same, "full").where(~F.col("_l").eqNullSafe(F.col("_r")))
    state = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "new").otherwise("changed")
    key_of = [F.when(F.col("_l").isNull(), F.col(f"r.{k}")).otherwise(F.col(f"l.{k}")).alias(k) for k in keys]
    return met.select(*key_of, state.alias("state"))
