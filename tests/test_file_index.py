"""The side table of files that may hold a key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from granary.operators import file_index
from granary.plans import logistics

FILES, ROWS = 40, 4000


def written(spark, path, numbers, files, scattered):
    rows = numbers.select(
        F.concat(F.lit("TH"), F.lpad(F.col("id").cast("string"), 10, "0")).alias("tracking_number"),
        F.col("id").alias("order_id"), F.lit("shipping").alias("status"), F.lit("x").alias("carrier"),
    )
    spread = rows.repartition(files, F.xxhash64("order_id")) if scattered else rows.repartitionByRange(files, "order_id")
    spread.write.mode("append").parquet(path)


def requests(spark, numbers):
    return spark.createDataFrame([(f" th{n:010d}\t",) for n in numbers], "query string")


def found(frame):
    return sorted((row.query.strip(), row.order_id) for row in frame.collect())


@pytest.mark.parametrize("scattered", [False, True])
def test_lookups_open_only_files_that_may_hold_them(spark, tmp_path, scattered):
    path, index = f"{tmp_path}/of 100%/table", f"{tmp_path}/index"
    written(spark, path, spark.range(ROWS * FILES), FILES, scattered)
    whole = spark.read.parquet(path)
    held = len(whole.inputFiles())
    assert logistics.index_tracking(spark, path, index) == held and logistics.index_tracking(spark, path, index) == 0
    # known numbers of a few files, and numbers that nobody holds
    few = [11, 12, 13, ROWS * FILES - 1]
    asked = requests(spark, [*few, *range(ROWS * FILES, ROWS * FILES + 20)])
    short = logistics.indexed_lookup(spark, asked, path, index)
    assert found(short) == found(logistics.tracking_lookup(asked, whole)) and len(found(short)) == 4
    keys = asked.select(F.lower(F.trim(F.translate("query", "\t", ""))).alias("key"))
    opened = file_index.candidates(spark, path, index, keys, "key")
    holders = {r.file for r in whole.where(F.col("order_id").isin(few)).select(F.input_file_name().alias("file")).distinct().collect()}
    assert len(holders) <= len(opened) <= len(holders) + 2 < held / 3


def test_a_thousand_lookups_lose_none(spark, tmp_path):
    path, index = f"{tmp_path}/table", f"{tmp_path}/index"
    written(spark, path, spark.range(60_000), 12, True)
    logistics.index_tracking(spark, path, index)
    asked = requests(spark, range(0, 120_000, 120))
    short = logistics.indexed_lookup(spark, asked, path, index)
    assert found(short) == [(f"th{n:010d}", n) for n in range(0, 60_000, 120)]


def test_files_that_came_or_went_since(spark, tmp_path):
    path, index = f"{tmp_path}/table", f"{tmp_path}/index"
    written(spark, path, spark.range(100), 2, False)
    asked = requests(spark, [5, 99, 150, 5])
    assert len(found(logistics.indexed_lookup(spark, asked, path, index))) == 3  # no index yet: all files
    logistics.index_tracking(spark, path, index)
    written(spark, path, spark.range(100, 200), 2, False)
    assert [n for _, n in found(logistics.indexed_lookup(spark, asked, path, index))] == [5, 5, 99, 150]
    assert logistics.index_tracking(spark, path, index) == 2
    file_index.entries(spark.read.parquet(path), F.lower("tracking_number")).write.mode("append").parquet(index)
    assert [n for _, n in found(logistics.indexed_lookup(spark, asked, path, index))] == [5, 5, 99, 150]


def test_empty_tables_null_and_blank_keys(spark, tmp_path):
    path, index = f"{tmp_path}/table", f"{tmp_path}/index"
    frame = spark.createDataFrame([(None, 1, "s", "c")] * 3, "tracking_number string, order_id long, status string, carrier string")
    frame.coalesce(1).write.parquet(path)
    assert logistics.index_tracking(spark, path, index) == 1
    asked = spark.createDataFrame([(None,), (" ",), ("th1",)], "query string")
    assert found(logistics.indexed_lookup(spark, asked, path, index)) == []
    assert file_index.candidates(spark, path, index, asked, "query") == []


def test_filters_of_large_files_take_more_bitmaps(spark, tmp_path):
    path = f"{tmp_path}/table"
    spark.range(50_000).coalesce(1).write.parquet(path)
    rows = file_index.entries(spark.read.parquet(path), F.col("id"))
    blocks = -(-50_000 * file_index.KEY_BITS // file_index.BLOCK_BITS)
    assert {r.blocks for r in rows.collect()} == {1 << (blocks - 1).bit_length()} and rows.count() <= 2 * blocks


def test_bitmaps_come_from_words_without_sorting_keys(spark, tmp_path):
    path = f"{tmp_path}/table"
    spark.range(9_000).repartition(3).write.parquet(path)
    spark.range(5).coalesce(1).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    rows = file_index.entries(table, F.col("id"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    # bit by bit what Spark's own bitmaps of the positions are
    places = table.select(F.col("_metadata.file_path").alias("file"), F.col("id").alias("key")).join(rows.select("file", "blocks").distinct(), "file")
    places = places.select("file", file_index._block(F.col("key"), F.col("blocks")).alias("block"), F.explode(F.array(*file_index._positions(F.col("key")))).alias("at"))
    expected = places.groupBy("file", "block").agg(F.call_function("bitmap_construct_agg", F.col("at")).alias("bits"))
    found = {(r.file, r.block): bytes(r.bits) for r in rows.collect()}
    assert found == {(r.file, r.block): bytes(r.bits) for r in expected.collect()} and len({f for f, _ in found}) == 4
