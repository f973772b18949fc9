"""Large quoted CSV files and JSON arrays, read by many tasks.

Where a record ends depends on all that stands before it: inside quotes a line
break or a brace ends nothing. So the file is cut at every line break (CSV) or
closing brace (JSON), which Spark's text reader does split by split, and each
piece is taken as a function of the state it begins in: what state it ends in,
begun outside quotes or inside them. Functions of pieces compose, so one row a
split tells in what state every split begins, and the pieces of a split follow
from there. Pieces that are a record by themselves stay where they are; only
those of records that are cut are brought together.

Positions count a file's records from 1, as a reader of the whole file would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.session import scratch_path, stage

_SPLIT = ("_file", "_block")
MARK = "\x1e"  # JSON has no such character, neither in strings nor between tokens


def _pieces(spark: SparkSession, path: str | list[str], ends_with: str) -> DataFrame:
    """``source_file, _file, _block, _seq, value``: the text between the marks, in order within each split."""
    rows = spark.read.option("lineSep", ends_with).text(path).select(
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
        "value",
    )
    # both passes must see the same tags; see file_positions
    rows = stage(rows, "file-pieces")
    first = rows.groupBy("_file").agg(F.min(F.struct("_block", "_seq")).alias("_first"))
    is_first = F.struct("_block", "_seq") == F.col("_first")
    return rows.join(first, "_file").withColumns(
        {"_opens": is_first, "value": F.when(is_first, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))}
    ).drop("_first")


def _up_to(row: int) -> object:
    return Window.partitionBy(*_SPLIT).orderBy("_seq").rowsBetween(Window.unboundedPreceding, row)


def _earlier() -> object:
    """The splits of the file before this one; one row a split."""
    return Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def _odd(number: Column) -> Column:
    return F.pmod(number, F.lit(2)).cast("int")


def with_states(pieces: DataFrame, begun_outside: Column, begun_inside: Column) -> DataFrame:
    """``pieces`` with ``_before`` and ``_after``: 1 where a piece begins and ends inside quotes, else 0.

    The columns tell where a piece ends if it begins outside or inside quotes.
    A piece keeps the state, turns it over, or settles it; the state is what
    the last settling piece left, turned over as often as pieces since then say.
    """
    marked = pieces.withColumns({"_o": begun_outside.cast("int"), "_i": begun_inside.cast("int")})
    turns = F.sum((F.col("_o") > F.col("_i")).cast("int"))
    settles = F.when(F.col("_o") == F.col("_i"), F.col("_o"))
    local = marked.withColumn("_turns", turns.over(_up_to(0))).withColumn(
        "_set", F.last(_odd(settles + F.col("_turns")), ignorenulls=True).over(_up_to(0))
    )
    splits = local.groupBy(*_SPLIT).agg(F.max("_turns").alias("_all"), F.max_by("_set", "_seq").alias("_left"))
    splits = splits.withColumn("_so_far", F.coalesce(F.sum("_all").over(_earlier()), F.lit(0)))
    splits = splits.withColumn("_global", _odd(F.col("_left") + F.col("_so_far")))
    left = F.last("_global", ignorenulls=True).over(_earlier())
    entry = stage(splits.select(*_SPLIT, _odd(F.coalesce(left, F.lit(0)) + F.col("_so_far")).alias("_entry")), "split-states")
    inside = local.join(entry, list(_SPLIT)).withColumn("_after", _odd(F.coalesce("_set", "_entry") + F.col("_turns")))
    before = F.lag("_after").over(Window.partitionBy(*_SPLIT).orderBy("_seq"))
    return inside.withColumn("_before", F.coalesce(before, "_entry")).drop("_o", "_i", "_turns", "_set", "_entry")


def _numbered(pieces: DataFrame, counts: Column, name: str, last: int) -> DataFrame:
    """``pieces`` with the sum of ``counts`` over the file's pieces up to ``last`` (0 or -1) rows from each."""
    marked = stage(pieces.withColumn("_count", counts.cast("long")), "counted-pieces")
    splits = marked.groupBy(*_SPLIT).agg(F.sum("_count").alias("_sum"))
    offsets = stage(splits.select(*_SPLIT, F.coalesce(F.sum("_sum").over(_earlier()), F.lit(0)).alias("_offset")), "split-offsets")
    within = F.coalesce(F.sum("_count").over(_up_to(last)), F.lit(0))
    return marked.join(offsets, list(_SPLIT)).withColumn(name, within + F.col("_offset")).drop("_count", "_offset")


def _together(pieces: DataFrame, glue: str) -> DataFrame:
    """``source_file, _file, _record, text, _pieces`` of the pieces of each record in order."""
    own = F.sort_array(F.collect_list(F.struct("_block", "_seq", "value")))
    return pieces.groupBy("source_file", "_file", "_record").agg(
        F.array_join(F.transform(own, lambda p: p["value"]), glue).alias("text")
    )


# ------------------------------------------------------------------------ CSV
def _ends(sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside quotes, begun outside and inside them. A quote opens at the start of a field only."""
    cut = "\\" + sep
    quoted = f'[^"]*+(?:""[^"]*+)*+"[^{cut}]*+'
    rest = f'(?:{cut}(?:"{quoted}|[^{cut}"][^{cut}]*+)?+)*+\\z'
    line, plain = F.col("value"), ~F.contains("value", F.lit('"'))
    outside = F.when(plain, 0).otherwise((~line.rlike(f'\\A(?s)(?:"{quoted}|[^{cut}"][^{cut}]*+)?+{rest}')).cast("int"))
    inside = F.when(plain, 1).otherwise((~line.rlike(f"\\A(?s){quoted}{rest}")).cast("int"))
    return outside, inside


def csv_texts(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """``source_file, _file, _record, text``: the records of CSV files, header included, blank lines not counted."""
    lines = with_states(_pieces(spark, path, "\n"), *_ends(sep))
    blank = F.col("value").isin("", "\r")
    starts = (F.col("_before") == 0) & ~blank
    lines = _numbered(lines.where((F.col("_before") == 1) | ~blank), starts, "_record", 0)
    alone = (F.col("_before") == 0) & (F.col("_after") == 0)
    columns = ["source_file", "_file", "_record", "text"]
    whole = lines.where(alone).withColumnRenamed("value", "text").select(*columns)
    cut = _together(lines.where(~alone), "\n").select(*columns)
    return whole.unionByName(cut).withColumn("text", F.regexp_replace("text", "\r\\z", ""))


def csv_rows(spark: SparkSession, path: str | list[str], columns: list[str], options: dict[str, str], sep: str = ",") -> DataFrame:
    """The records below the header as columns, with ``source_file, _file, _record``."""
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in columns)
    parsed = csv_texts(spark, path, sep).where("_record > 1").withColumn(
        "_row", F.from_csv("text", schema, options | {"sep": sep, "multiLine": "true"})
    )
    return parsed.select("source_file", "_file", "_record", "_row.*")


# ----------------------------------------------------------------- JSON arrays
def json_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``source_file, _file, _record, text``: the objects of files that hold one JSON array (or one object) each."""
    pieces = _pieces(spark, path, "}")
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    odd = _odd(F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit(""))))
    pieces = with_states(pieces.withColumn("_bare", bare), odd, 1 - odd)
    # of the parts between quotes every second one is outside; brackets count there only
    parts = F.filter(F.split("_bare", '"'), lambda _, place: _odd(place) == F.col("_before"))
    outside = F.array_join(parts, " ")
    opened = F.regexp_count(outside, F.lit(r"[\[{]")) - F.regexp_count(outside, F.lit(r"\]"))
    pieces = pieces.withColumn("_deeper", opened - (F.col("_after") == 0).cast("int")).drop("_bare")
    pieces = _numbered(pieces, F.col("_deeper"), "_depth", 0)
    base = pieces.where("_opens").select("_file", F.when(F.col("value").rlike(r"\A\s*\["), 1).otherwise(0).alias("_base"))
    pieces = pieces.join(base, "_file").withColumn("_ends", (F.col("_after") == 0) & (F.col("_depth") == F.col("_base")))
    pieces = _numbered(pieces, F.col("_ends"), "_earlier", -1).withColumn("_record", F.col("_earlier") + 1)
    starts = F.coalesce(F.lag("_ends").over(Window.partitionBy(*_SPLIT).orderBy("_seq")), F.col("_opens"))
    pieces = stage(pieces.withColumn("_alone", F.col("_ends") & starts), "array-pieces")
    columns = ["source_file", "_file", "_record", "text"]
    whole = pieces.where("_alone").withColumnRenamed("value", "text").select(*columns)
    rest = pieces.where("not _alone")
    ended = rest.groupBy("_file", "_record").agg(F.max("_ends").alias("_ended"))
    cut = _together(rest, "}").join(ended, ["_file", "_record"])
    # what follows the last element closes the array, or the file is cut short
    closing = F.col("text").rlike(r"\A[\s\[\],]*\z")
    cut = cut.where(F.col("_ended") | ~closing).withColumn(
        "text", F.when(F.col("_ended"), F.col("text")).otherwise(F.raise_error(F.concat(F.lit("broken JSON array: "), "_file")))
    )
    text = F.concat(F.regexp_replace("text", r"\A[\s\[,]+", ""), F.lit("}"))
    return whole.unionByName(cut.select(*columns)).withColumn("text", text)


def json_rows(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> DataFrame:
    """The elements as columns, those that any of them has, with ``source_file, _file, _record``."""
    lines = scratch_path(spark, "array-elements")
    where = F.to_json(F.struct("source_file", "_file", F.col("_record").cast("string").alias("_record")))
    rows = json_elements(spark, path).select(F.concat(F.lit('{"w":'), where, F.lit(',"e":'), F.col("text"), F.lit("}")))
    rows.write.option("lineSep", MARK).text(lines)
    found = spark.read.options(**options).option("lineSep", MARK).json(lines)
    if "e" not in found.columns:  # no element at all
        return spark.createDataFrame([], "source_file string, _file string, _record long")
    return found.select("w.source_file", "w._file", F.col("w._record").cast("long").alias("_record"), "e.*")
