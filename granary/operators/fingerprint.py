"""Content hashes that merge, so no task has to read a whole table or group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_digest(columns: list[str | Column]) -> Column:
    """SHA-256 of a row's fields as text; NULL and empty stay different."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\\N")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


LANE_STARTS = (1, 11, 21, 31)
LANE_BITS = 20


def _lane_sums() -> list[Column]:
    """Sums over four slices of a digest, each slice halved.

    A slice is ten hex digits, summed as two numbers below 2**20, so a long
    holds the sums of more than 10**12 rows; beyond that the sum fails rather
    than wraps.
    """
    sums = []
    for start in LANE_STARTS:
        lane = F.conv(F.substring("_digest", start, 10), 16, 10).cast("bigint")
        sums.append(F.sum(F.shiftright(lane, LANE_BITS)).alias(f"_high{start}"))
        sums.append(F.sum(lane.bitwiseAND((1 << LANE_BITS) - 1)).alias(f"_low{start}"))
    return sums


def group_fingerprint(df: DataFrame, keys: list[str], columns: list[str | Column]) -> DataFrame:
    """``rows, fingerprint`` per group, independent of row order.

    The digest of a group is the SHA-256 over its row count and the sums of
    slices of its row digests. Sums combine map-side, so a group of any size
    costs one partial row per task; copies of a row still count.
    """
    sums = df.select(*keys, row_digest(columns).alias("_digest")).groupBy(*keys).agg(
        F.count("*").alias("rows"), *_lane_sums()
    )
    parts = ["rows", *[f"_{half}{start}" for start in LANE_STARTS for half in ("high", "low")]]
    text = F.concat_ws("|", *[F.col(p).cast("string") for p in parts])
    return sums.select(*keys, "rows", F.sha2(text, 256).alias("fingerprint"))


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``name, length, sha256`` of each file, hashed where the file is read."""
    return (
        spark.read.format("binaryFile")
        .load(folder)
        .select(
            F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
            "length",
            F.sha2("content", 256).alias("sha256"),
        )
    )


def batch_id(spark: SparkSession, folder: str, names: tuple[str, ...], version: str) -> str:
    """Sixteen hex digits that change with the version or any file's content."""
    digests = file_digests(spark, folder).filter(F.col("name").isin(*names))
    # one short line per required file: the list is as long as ``names``
    lines = sorted(f"{row.name}:{row.sha256}" for row in digests.collect())
    combined = spark.range(1).select(F.sha2(F.lit("|".join([version, *lines])), 256).alias("id"))
    return combined.first().id[:16]


def manifest_diff(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Compare two ``name, digest`` tables: new, missing, same or conflict."""
    both = existing.select("name", F.col("digest").alias("old")).join(
        incoming.select("name", F.col("digest").alias("new")), "name", "full_outer"
    )
    state = (
        F.when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "missing")
        .when(F.col("old") == F.col("new"), "same")
        .otherwise("conflict")
    )
    return both.select("name", state.alias("state"))
