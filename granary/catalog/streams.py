"""Streaming queries run to the end of what is there, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.catalog.registry import query
from granary.session import scratch_path
from granary.sources import sample
from granary.streaming import jobs, state, windows


@query(
    "stream_latest_rating",
    """SELECT user_id AS id, value AS rating, ts AS updated_at FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events)
       WHERE rank = 1""",
)
def stream_latest_rating(spark, folder):
    out = scratch_path(spark, "latest-rating")
    updates = sample.rating_columns(jobs.table_stream(spark, folder, "events"))
    jobs.rating_feed(updates, out, f"{out}-checkpoint")
    return state.current(spark, out, ["id"])


@query("stream_stock_level", "SELECT product_id, quantity FROM levels")
def stream_stock_level(spark, folder):
    out = scratch_path(spark, "stock-level")
    log = sample.log_columns(jobs.table_stream(spark, folder, "events"))
    jobs.stock_feed(log, out, f"{out}-checkpoint")
    return state.current(spark, out, ["product_id"])


@query(
    "stream_daily_totals",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS events,
              CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
       FROM events GROUP BY day""",
)
def stream_daily_totals(spark, folder):
    out = scratch_path(spark, "daily-totals")
    events = jobs.table_stream(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("decimal(18,2)").alias("amount")
    )
    jobs.daily_feed(events, out, f"{out}-checkpoint")
    return state.current(spark, out, ["day"]).select("day", "events", "amount")


@query(
    "stream_rejected_payloads",
    """SELECT event_id, id, CASE WHEN rating_text IS NULL THEN 'rating is required'
              ELSE 'rating must be a number' END AS error
       FROM bodies WHERE try_cast(rating_text AS DOUBLE) IS NULL""",
)
def stream_rejected_payloads(spark, folder):
    out = scratch_path(spark, "payloads")
    bodies = sample.payload_columns(jobs.table_stream(spark, folder, "events"))
    jobs.payload_feed(bodies, out, f"{out}-checkpoint")
    return state.read_deltas(spark, f"{out}/rejected").select("event_id", "id", "error")


@query(
    "stream_closed_days",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS events,
              CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount,
              CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY
                  <= (SELECT max(ts) FROM events) - INTERVAL 36 HOUR AS closed
       FROM events GROUP BY day, closed""",
)
def stream_closed_days(spark, folder):
    """Events out of order over several batches, some days late: closed, open and late rows together."""
    landing, out = scratch_path(spark, "arrivals"), scratch_path(spark, "closed-days")
    events = sample.table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("decimal(18,2)").alias("amount")
    )
    delay = F.when(F.col("event_id") % 40 == 0, 120 * 3600).otherwise(F.col("event_id") % 30 * 3600)
    arrival = F.floor((F.unix_timestamp("ts") + delay) / (5 * 86400))
    events.withColumn("arrival", arrival).repartition("arrival").write.partitionBy("arrival").parquet(landing)
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{landing}/*")
    windows.closing_feed(feed.select("ts", "amount"), out, f"{out}-checkpoint", lateness="36 hours")
    totals = windows.all_totals(spark, out)
    return totals.select(F.col("start").cast("date").alias("day"), "events", "amount", "closed")
