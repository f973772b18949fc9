"""Tumbling event-time windows that close, and what comes too late for them.

Each micro-batch adds its windows' sums to those still open, moves the
watermark to the newest event time less the lateness allowed, sends the windows
that end before it to the closed ones, once, and keeps the others. Rows of a
window that an earlier batch has closed go to a side table, as do rows without
an event time, so that closed, open and late rows together are all rows,
however the input is cut into batches.

The state is a row for each window still open and one for the watermark. Every
batch writes its own under its number, reads that of the batch before and drops
the one before that, so a repeated batch overwrites itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import exists, file_system, stage
from granary.streaming import state

TOTALS = ("events", "amount")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if exists(spark, path) else None


def _sums() -> list[Column]:
    return [F.sum("events").alias("events"), F.sum("amount").cast("decimal(18,2)").alias("amount")]


def window_closer(out: str, lateness: str, width: str, keys: tuple[str, ...] = ()):
    """A foreachBatch function over ``ts``, ``amount`` and the keys."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        progress = _read(spark, f"{out}/progress/batch={batch_id - 1}")
        earlier = progress.first() if progress is not None else None  # one row
        passed = F.lit(earlier.watermark if earlier else None).cast("timestamp")

        window = F.window("ts", width)
        sums = stage(
            batch.groupBy(window.alias("_window"), *keys)
            .agg(F.count(F.lit(1)).alias("events"), F.sum("amount").cast("decimal(18,2)").alias("amount"), F.max("ts").alias("_newest"))
            .select(F.col("_window.start").alias("start"), F.col("_window.end").alias("end"), *keys, *TOTALS, "_newest"),
            "batch-windows",
        )
        in_time = sums.where(F.coalesce(F.col("end") > passed, F.lit(True)))
        newest = sums.agg(F.greatest(F.max("_newest"), F.lit(earlier.newest if earlier else None).cast("timestamp")).alias("newest"))
        ahead = newest.select(
            "newest", F.greatest(passed, F.col("newest") - F.expr(f"interval {lateness}")).alias("watermark")
        ).first()  # one row
        watermark = F.lit(ahead.watermark).cast("timestamp")

        open_before = _read(spark, f"{out}/open/batch={batch_id - 1}")
        running = in_time.select("start", "end", *keys, *TOTALS)
        if open_before is not None:
            running = running.unionByName(open_before)
        running = stage(running.groupBy("start", "end", *keys).agg(*_sums()), "running-windows")
        over = F.coalesce(F.col("end") <= watermark, F.lit(False))
        running.where(over).write.mode("overwrite").parquet(f"{out}/closed/batch={batch_id}")
        running.where(~over).write.mode("overwrite").parquet(f"{out}/open/batch={batch_id}")

        # a window that ended by the watermark holds only what is older than the window the watermark stands in
        late = F.col("ts").isNull()
        if earlier and earlier.watermark is not None:
            bound = spark.range(1).select(passed.alias("ts")).groupBy(F.window("ts", width)).count().first().window.start
            late = late | (F.col("ts") < F.lit(bound).cast("timestamp"))
        reason = F.when(F.col("ts").isNull(), "no event time").otherwise("late")
        batch.where(late).withColumn("reason", reason).write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")

        spark.createDataFrame([(ahead.newest, ahead.watermark)], "newest timestamp, watermark timestamp").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{out}/progress/batch={batch_id}")
        for name in ("open", "progress"):
            done, files = file_system(spark, f"{out}/{name}/batch={batch_id - 2}")
            files.delete(done, True)

    return write


def closing_feed(
    events: DataFrame, out: str, checkpoint: str, lateness: str = "1 day", width: str = "1 day", keys: tuple[str, ...] = ()
) -> None:
    """Totals per window of ``ts``: each window leaves once, when the watermark has passed its end."""
    writer = events.writeStream.foreachBatch(window_closer(out, lateness, width, keys))
    state.run_available(writer, checkpoint)


def closed(spark: SparkSession, out: str) -> DataFrame:
    """Windows that are over, with their final totals and the batch that closed them."""
    return spark.read.parquet(f"{out}/closed")


def still_open(spark: SparkSession, out: str) -> DataFrame:
    """Windows that may still grow, with their totals so far."""
    held = spark.read.parquet(f"{out}/open")
    return held.where(F.col("batch") == F.lit(held.agg(F.max("batch")).first()[0])).drop("batch")


def late_events(spark: SparkSession, out: str) -> DataFrame:
    """Rows that no window holds, with the reason and the batch that brought them."""
    return spark.read.parquet(f"{out}/late")


def all_totals(spark: SparkSession, out: str, width: str = "1 day", keys: tuple[str, ...] = ()) -> DataFrame:
    """``start, keys, events, amount, late_events, closed``: late rows added to their windows."""
    parts = [
        closed(spark, out).select("start", *keys, *TOTALS, F.lit(0).cast("long").alias("late_events"), F.lit(True).alias("closed")),
        still_open(spark, out).select("start", *keys, *TOTALS, F.lit(0).cast("long").alias("late_events"), F.lit(False).alias("closed")),
    ]
    late = late_events(spark, out).where("ts is not null").groupBy(F.window("ts", width).alias("_window"), *keys)
    added = late.agg(F.count(F.lit(1)).alias("events"), F.sum("amount").cast("decimal(18,2)").alias("amount"))
    parts.append(added.select(F.col("_window.start").alias("start"), *keys, *TOTALS, F.col("events").alias("late_events"), F.lit(True).alias("closed")))
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy("start", *keys).agg(*_sums(), F.sum("late_events").alias("late_events"), F.bool_or("closed").alias("closed"))
