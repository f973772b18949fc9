"""A side table that tells which files of a table may hold a key.

Per file it keeps the lowest and highest key and a Bloom filter. The filter is
blocked: a key has all its bits in one bitmap of 4 KB, and a file has as many
bitmaps, a power of two, as its keys need. So a lookup meets one bitmap a file
by an equality join, and opens only files whose range and bits allow the key.

A key is never lost: files that the index does not know yet are always opened,
files that are gone are passed over, and what was indexed twice counts once.
The candidates that come to the driver are file names, which Spark's own
listing of the table holds there anyway. Meant for few keys against many files;
asking for a good part of all keys opens every file, and a plain join is better.
"""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import exists

BLOCK_BITS = 32_768  # of one bitmap, as the bitmap functions have it
WORD_BITS = 64
KEY_BITS = 12
PROBES = 5


def _plain(uri: str) -> str:
    """The path of a file however its address is written."""
    return unquote(urlsplit(uri).path)


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), blocks)


def _positions(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(n), key), F.lit(BLOCK_BITS)) for n in range(1, PROBES + 1)]


def _bit_is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (position % 8).cast("int"))) != 0


def _word_bit(position: Column) -> Column:
    """The bit of a position in its word of eight bytes, the first byte being the highest."""
    in_word = position % WORD_BITS
    shift = (F.lit(7) - F.floor(in_word / 8)) * 8 + in_word % 8
    return F.call_function("shiftleft", F.lit(1).cast("long"), shift.cast("int"))


def _bitmap(words: Column) -> Column:
    """The bytes of a bitmap from its words, an array of ``_word, _bits`` without the words that are zero."""
    missing = F.array_except(F.sequence(F.lit(0), F.lit(BLOCK_BITS // WORD_BITS - 1)), words.getField("_word"))
    zeros = F.transform(missing, lambda n: F.struct(n.alias("_word"), F.lit(0).cast("long").alias("_bits")))
    return F.unhex(F.array_join(
        F.transform(F.sort_array(F.concat(words, zeros)), lambda w: F.lpad(F.hex(w.getField("_bits")), WORD_BITS // 4, "0")), ""
    ))


def entries(table: DataFrame, key: Column) -> DataFrame:
    """``file, low, high, blocks, block, bits``: a row per file and bitmap in use.

    Two passes over the key column; a file without keys has one row without a
    bitmap. Bits are put together by words of 64, which a task does without
    sorting its keys; at most 512 words then make a bitmap.
    """
    keys = table.select(F.col("_metadata.file_path").alias("file"), key.alias("_key"))
    ends = keys.groupBy("file").agg(
        F.count("_key").alias("_keys"), F.min("_key").alias("low"), F.max("_key").alias("high")
    )
    wanted = F.ceil(F.greatest(F.col("_keys"), F.lit(1)) * KEY_BITS / BLOCK_BITS)
    files = ends.withColumn("blocks", F.pow(F.lit(2.0), F.ceil(F.log2(wanted.cast("double")))).cast("long")).drop("_keys")
    # should two names ever share a hash, the bits of both allow their keys, so none is lost
    files = files.withColumn("_file", F.xxhash64("file"))
    placed = (
        keys.where(F.col("_key").isNotNull())
        .join(files.select("file", "_file", "blocks"), "file")
        .select("_file", _block(F.col("_key"), F.col("blocks")).alias("block"), F.explode(F.array(*_positions(F.col("_key")))).alias("_at"))
    )
    words = placed.groupBy("_file", "block", F.floor(F.col("_at") / WORD_BITS).cast("int").alias("_word")).agg(
        F.bit_or(_word_bit(F.col("_at"))).alias("_bits")
    )
    bits = words.groupBy("_file", "block").agg(_bitmap(F.collect_list(F.struct("_word", "_bits"))).alias("bits"))
    return files.join(bits, "_file", "left").select("file", "low", "high", "blocks", "block", "bits")


def _files(table: DataFrame) -> dict[str, str]:
    """Path of each file of a table, and the name to open it by."""
    return {_plain(uri): unquote(uri) for uri in table.inputFiles()}


def _opened(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files)


def update(spark: SparkSession, path: str, index: str, key: Column) -> int:
    """Index the files under ``path`` that ``index`` does not know yet; how many they were."""
    known = set()
    if exists(spark, index):
        known = {_plain(row.file) for row in spark.read.parquet(index).select("file").distinct().collect()}
    new = [name for place, name in sorted(_files(spark.read.parquet(path)).items()) if place not in known]
    if new:
        entries(_opened(spark, path, new), key).write.mode("append").parquet(index)
    return len(new)


def candidates(spark: SparkSession, path: str, index: str, asked: DataFrame, key: str) -> list[str]:
    """Files under ``path`` that may hold one of the asked keys; NULL is in none."""
    present = _files(spark.read.parquet(path))
    if not exists(spark, index):
        return sorted(present.values())
    rows = spark.read.parquet(index)
    known = {_plain(row.file): row.blocks for row in rows.select("file", "blocks").distinct().collect()}
    sizes = sorted(set(known.values()))
    probes = (
        asked.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct()
        .withColumn("blocks", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])))
        .withColumn("block", _block(F.col("_key"), F.col("blocks")))
    )
    met = probes.join(rows, ["blocks", "block"]).where(F.col("_key").between(F.col("low"), F.col("high")))
    for position in _positions(F.col("_key")):
        met = met.where(_bit_is_set(F.col("bits"), position))
    hit = {_plain(row.file) for row in met.select("file").distinct().collect()}
    return sorted(name for place, name in present.items() if place in hit or place not in known)


def pruned(spark: SparkSession, path: str, index: str, asked: DataFrame, key: str) -> DataFrame:
    """The table under ``path``, read from the files alone that may hold one of the asked keys."""
    return _opened(spark, path, candidates(spark, path, index, asked, key))
