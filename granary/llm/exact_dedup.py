"""Exact duplicates: a Bloom filter of what repeats decides which rows shuffle.

The first pass counts, for the bit positions that the texts' hashes fall on, how
often each is hit, and keeps in bitmaps the positions hit twice or more. The
second pass tests every hash: where one of its positions was hit once only, no
other row has its text, and the row goes straight through. Only the others,
repeated texts and the filter's false alarms, are grouped by their SHA-256.
Everything is built-in DataFrame work.

The filter takes ``BITS_PER_ROW`` bits a row up to ``MOST_BITS`` (128 MB, the
most that is broadcast), in blocks of 32,768 bits that one row's positions
share. Beyond some 70 million rows it fills up: more rows then join the
shuffle, which moves digests and never texts in ``mark_digests``; results stay
the same. The first pass shuffles bit positions, combined in each task, so a
text that a third of the rows hold sends one row a task. Groups meet their rows
in a join of two staged tables, whose hot keys AQE splits.

Defined results: a null text counts as empty and empty texts are equal; texts
of any length are hashed whole; of equal texts the row with the largest id
stays, a null id only if all are null, and of rows tied there the first
written; repeated rows are copies; an empty table gives an empty result. Input
columns named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary import session
from granary.llm import text as T
from granary.llm.frames import shielded, without

BLOCK = 32_768  # bits of one bitmap of bitmap_construct_agg
BITS_PER_ROW = 16
MOST_BITS = 1 << 30
HASHES = 3

ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def digest(text: str | Column) -> Column:
    """SHA-256 of the whole text's UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(T.whole(text).cast("binary"), 256))


def blocks_for(rows: int) -> int:
    """Number of bitmaps for so many rows, a power of two."""
    wanted = min(MOST_BITS, max(BLOCK, rows * BITS_PER_ROW))
    return 1 << ((wanted + BLOCK - 1) // BLOCK - 1).bit_length()


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("_digest"), F.lit(blocks)).cast("int")


def _position(n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(n), F.col("_digest")), F.lit(BLOCK)).cast("int")


def repeated_positions(digests: DataFrame, blocks: int) -> DataFrame:
    """First pass: ``_block, _bits`` with a bit set where the rows of ``_digest`` hit a position twice or more.

    At most ``blocks`` rows of 4 KB; blocks without such a position are left out.
    """
    # two of one row's positions may be the same; that is one hit
    hits = digests.select(
        _block(blocks).alias("_block"),
        F.explode(F.array_distinct(F.array(*[_position(n) for n in range(HASHES)]))).alias("_at"),
    )
    twice = hits.groupBy("_block", "_at").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return (
        twice.repartition("_block")
        .groupBy("_block")
        .agg(F.call_function("bitmap_construct_agg", F.col("_at").cast("long")).alias("_bits"))
    )


def _bit(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), at % 8 + 1)) != 0


def with_repeated(rows: DataFrame, positions: DataFrame, blocks: int) -> DataFrame:
    """Second pass: ``rows`` with ``_repeated``, false where no other row has the digest."""
    # bounded by blocks x 4 KB
    tested = rows.withColumn("_block", _block(blocks)).join(F.broadcast(positions), "_block", "left")
    all_hit = F.col("_bits").isNotNull()
    for n in range(HASHES):
        all_hit = all_hit & _bit(F.col("_bits"), _position(n))
    return tested.withColumn("_repeated", F.coalesce(all_hit, F.lit(False))).drop("_block", "_bits")


def mark_digests(rows: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``rows`` (with ``_digest``) plus ``keep_id, group_size, kept``; rows that cannot repeat are not shuffled."""
    columns, ids = rows.columns, F.col(id_column)
    blocks = blocks_for(rows.count())
    positions = session.stage(repeated_positions(rows.select("_digest"), blocks), "repeated-positions")
    tested = with_repeated(rows, positions, blocks)
    alone = tested.where(~F.col("_repeated")).select(
        *columns, ids.alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    maybe = session.stage(
        tested.where("_repeated").select(*columns, F.monotonically_increasing_id().alias("_row")), "repeated-texts"
    )
    first = F.max(F.struct(ids.alias("id"), (-F.col("_row")).alias("row"))).alias("_first")
    groups = session.stage(
        maybe.groupBy("_digest").agg(F.count(F.lit(1)).alias("group_size"), first), "text-groups"
    )
    grouped = maybe.join(groups, "_digest").select(
        *columns,
        F.col("_first.id").alias("keep_id"),
        "group_size",
        (F.col("_first.row") == -F.col("_row")).alias("kept"),
    )
    return alone.unionByName(grouped)


@shielded
def mark(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``docs`` with ``keep_id, group_size, kept, text_sha256``; of the rows only possible copies shuffle."""
    docs = without(docs, *(set(ADDED) - {text, id_column})).withColumn("_digest", digest(text))
    marked = mark_digests(docs, id_column)
    return marked.withColumn("text_sha256", F.lower(F.hex("_digest"))).drop("_digest")


def duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document: its id, ``keep_id, group_size, kept, text_sha256``; texts are read once."""
    narrow = session.stage(docs.select(F.col(id_column), digest(text).alias("_digest")), "text-digests")
    return mark_digests(narrow, id_column).select(
        id_column, "keep_id", "group_size", "kept", F.lower(F.hex("_digest")).alias("text_sha256")
    )


def deduplicate(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay."""
    away = {name: f"granary_kept_{i}" for i, name in enumerate(docs.columns) if name.lower() in ADDED}
    renamed = docs.withColumnsRenamed(away)
    marked = mark(renamed, away.get(text, text), away.get(id_column, id_column)).where("kept").drop(*ADDED)
    return marked.withColumnsRenamed({new: old for old, new in away.items()})
