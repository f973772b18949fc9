"""Rating feed, stock levels, daily totals and incremental landing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.contracts import BRONZE_METADATA, ORDER_FIELDS
from granary.functions import payload
from granary.operators.keys import file_positions
from granary.plans.bronze import load_time
from granary.session import exists
from granary.sources import files, sample
from granary.streaming import state


def table_stream(spark: SparkSession, folder: str, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Stream over one sample table, stored as a file or as a folder of files.

    The braces make the path a pattern: a plain path has to be a folder.
    ``batch_bytes`` cuts a backlog into batches, so that a failure repeats
    less; what a job has written in the end does not depend on it.
    """
    reader = spark.readStream.schema(sample.SCHEMAS[name])
    if batch_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", batch_bytes)
    return reader.parquet(f"{folder}/{{{name}}}.parquet")


# ------------------------------------------------------------- rating updates
def latest_rating(updates: DataFrame) -> DataFrame:
    """Last rating per entity by event time, ties by event id.

    Works on a table and on a stream; the state holds one row per entity.
    """
    last = F.max_by(F.struct("rating", "updated_at"), F.struct("updated_at", "event_id")).alias("_last")
    return updates.groupBy("id").agg(last).select("id", "_last.rating", "_last.updated_at")


def parsed_updates(raw: DataFrame) -> DataFrame:
    """Rating and refusal reason of each payload."""
    text = raw.withColumn("rating_text", payload.rating_text("body"))
    return text.withColumn("error", payload.rating_error("rating_text")).withColumn(
        "rating", payload.rating_value("rating_text")
    )


def split_updates(batch: DataFrame) -> dict[str, DataFrame]:
    """Good updates and refused ones with their reason."""
    return {
        "accepted": batch.filter("error is null").drop("error", "rating_text", "body"),
        "rejected": batch.filter("error is not null").select("event_id", "id", "body", "error"),
    }


def rating_feed(updates: DataFrame, out: str, checkpoint: str) -> None:
    """Keep the latest rating per entity up to date."""
    writer = latest_rating(updates).writeStream.outputMode("update").foreachBatch(state.delta_writer(out))
    state.run_available(writer, checkpoint)


def payload_feed(raw: DataFrame, out: str, checkpoint: str) -> None:
    """Write good updates and refused ones to separate tables."""
    writer = parsed_updates(raw).writeStream.foreachBatch(state.delta_writer(out, split_updates))
    state.run_available(writer, checkpoint)


# --------------------------------------------------------------- stock levels
def stock_feed(log: DataFrame, out: str, checkpoint: str) -> None:
    """Maintain the stock level of each product from its movements."""
    levels = log.groupBy("product_id").agg(F.sum("change_quantity").cast("bigint").alias("quantity"))
    writer = levels.writeStream.outputMode("update").foreachBatch(state.delta_writer(out))
    state.run_available(writer, checkpoint)


# --------------------------------------------------------------- daily totals
def daily_totals(events: DataFrame) -> DataFrame:
    """Count and amount per day of event time, and the newest event of the day.

    The state is one row per day, so it needs no watermark, and no event is
    dropped for arriving in a late batch.
    """
    return events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("events"),
        F.sum("amount").cast("decimal(18,2)").alias("amount"),
        F.max("ts").alias("newest"),
    )


def daily_feed(events: DataFrame, out: str, checkpoint: str) -> None:
    """Daily totals: each batch sends the days it changed and readers take the newest."""
    writer = daily_totals(events).writeStream.outputMode("update").foreachBatch(state.delta_writer(out))
    state.run_available(writer, checkpoint)


def closed_days(spark: SparkSession, out: str, lateness: str = "1 day") -> DataFrame:
    """Days that ended at least ``lateness`` before the newest event seen, with their totals so far."""
    days = state.current(spark, out, ["day"])
    newest = days.agg(F.max("newest")).first()[0]  # one value
    ended = F.date_add("day", 1).cast("timestamp") + F.expr(f"interval {lateness}")
    return days.filter(ended <= F.lit(newest)).drop("newest")


# -------------------------------------------------------- incremental landing
ARRIVAL = "path string, modificationTime timestamp, length bigint, content binary"


def landing_feed(
    spark: SparkSession, landing: str, out: str, checkpoint: str, files_per_batch: int = 1000,
    quoted_newlines: bool = True,
) -> None:
    """Append new landing files of every supported format to Bronze, each file once.

    The stream carries the paths of new files only; their rows come from the
    batch readers and are numbered as in a full load, ``bronze_id`` going on
    from the batches before. A repeated batch overwrites itself.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(ARRIVAL)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select("path")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(row.path for row in batch.collect())  # at most files_per_batch
        parts = [
            files.read_records(spark, suffix, wanted, ORDER_FIELDS, quoted_newlines)
            for suffix in files.READERS
            if (wanted := [path for path in paths if path.endswith(suffix)])
        ]
        # the last id stands beside each batch, in a folder that readers of the table pass over
        known = f"{out}/_last/batch={batch_id - 1}"
        before = 0
        if batch_id and exists(spark, known):
            before = spark.read.parquet(known).first().last
        elif batch_id and exists(spark, out):  # written before the last id was kept
            before = spark.read.parquet(out).where(F.col("batch") < batch_id).agg(F.max("bronze_id")).first()[0] or 0
        last = F.lit(before).cast("long").alias("last")
        if not parts:
            spark.range(1).select(last).write.mode("overwrite").parquet(f"{out}/_last/batch={batch_id}")
            return
        numbered = file_positions(reduce(DataFrame.unionByName, parts))
        rows = numbered.withColumns({"bronze_id": F.col("bronze_id") + before, "extracted_at": F.lit(load_time())})
        path = f"{out}/batch={batch_id}"
        rows.select(*BRONZE_METADATA, *ORDER_FIELDS).write.mode("overwrite").parquet(path)
        reached = spark.read.parquet(path).agg(F.coalesce(F.max("bronze_id"), F.lit(before)).cast("long").alias("last"))
        reached.write.mode("overwrite").parquet(f"{out}/_last/batch={batch_id}")

    state.run_available(arrivals.writeStream.foreachBatch(write), checkpoint)
