"""Stock ledger, levels, daily snapshots and oversell checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import dates, text
from granary.operators.ordering import running_total


def stock_levels(log: DataFrame) -> DataFrame:
    """Current quantity per product: the sum of its movements."""
    return log.groupBy("product_id").agg(F.sum("change_quantity").cast("bigint").alias("quantity"))


def is_low_stock():
    return F.col("quantity") <= F.col("reorder_point")


def low_stock(levels: DataFrame) -> DataFrame:
    """Products at or below their reorder point, with the distance to it."""
    return levels.filter(is_low_stock()).withColumn("margin", F.col("quantity") - F.col("reorder_point"))


def inventory_stats(levels: DataFrame) -> DataFrame:
    return levels.agg(
        F.sum("quantity").cast("bigint").alias("total_items"),
        F.count_if(is_low_stock()).alias("low_stock_count"),
        F.count("*").alias("sku_count"),
    )


def running_balance(log: DataFrame) -> DataFrame:
    """Stock of the product after each movement."""
    return running_total(log, ["product_id"], ["created_at", "log_id"], "change_quantity", "balance")


def recent_log(log: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The newest movements with product name and a signed quantity."""
    newest = log.orderBy(F.desc("created_at"), F.desc("log_id")).limit(n)
    return newest.join(products.select("product_id", "product_name"), "product_id").select(
        "log_id",
        "created_at",
        "product_name",
        "log_type",
        text.signed("change_quantity").alias("change"),
        text.text_or_dash("reason").alias("reason"),
    )


def available(products: DataFrame, levels: DataFrame) -> DataFrame:
    """Quantity on hand of every product; 0 without a stock row."""
    return products.select("product_id").join(levels.select("product_id", "quantity"), "product_id", "left").select(
        "product_id", F.coalesce("quantity", F.lit(0)).cast("bigint").alias("available")
    )


def fact_inventory(log: DataFrame) -> DataFrame:
    return log.select(
        "log_id",
        dates.date_key("created_at").alias("date_key"),
        F.col("product_id").alias("product_key"),
        "log_type",
        "change_quantity",
    )


def daily_movements(log: DataFrame) -> DataFrame:
    """Net change and outbound quantity per product and day.

    At most one row per product and day is left, so the windows below stay
    small even for a product with a third of the movements.
    """
    outbound = F.when(F.col("log_type") == "outbound", -F.col("change_quantity")).otherwise(0)
    return log.groupBy("product_id", F.to_date("created_at").alias("day")).agg(
        F.sum("change_quantity").cast("bigint").alias("change"), F.sum(outbound).cast("bigint").alias("outbound")
    )


def stock_snapshot(log: DataFrame, reorder_points: DataFrame) -> DataFrame:
    """Quantity per product for every day from its first to its last movement.

    Each movement day repeats its closing quantity until the next one, which
    fills the gaps without a join against a calendar. A product without a
    reorder point is never low.
    """
    by_day = Window.partitionBy("product_id").orderBy("day")
    closing = daily_movements(log).select(
        "product_id",
        "day",
        F.sum("change").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("quantity"),
        F.date_sub(F.lead("day").over(by_day), 1).alias("last"),
    )
    filled = closing.withColumn("day", F.explode(F.sequence("day", F.coalesce("last", "day"))))
    return filled.join(reorder_points, "product_id", "left").select(
        dates.date_key("day").alias("snapshot_date_key"),
        F.col("product_id").alias("product_key"),
        F.col("quantity").cast("bigint").alias("current_quantity"),
        F.coalesce(is_low_stock(), F.lit(False)).alias("is_low_stock"),
    )


def days_of_supply(log: DataFrame, trailing_days: int = 30) -> DataFrame:
    """Quantity over mean daily outbound of the trailing days; NULL without any."""
    numbered = daily_movements(log).withColumn("_n", F.unix_date("day"))
    by_day = Window.partitionBy("product_id").orderBy("_n")
    measured = numbered.select(
        "product_id",
        "day",
        F.sum("change").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("quantity"),
        F.sum("outbound").over(by_day.rangeBetween(1 - trailing_days, 0)).alias("outbound"),
    )
    supply = (F.col("quantity") * trailing_days).cast("decimal(24,6)") / F.nullif("outbound", F.lit(0)).cast("decimal(18,0)")
    return measured.select(
        dates.date_key("day").alias("snapshot_date_key"),
        F.col("product_id").alias("product_key"),
        F.col("quantity").cast("bigint").alias("current_quantity"),
        F.round(supply, 4).cast("decimal(18,4)").alias("days_of_supply"),
    )


def documented_snapshot(log: DataFrame, reorder_points: DataFrame, trailing_days: int = 30) -> DataFrame:
    """Quantity, low-stock flag and days of supply for every day of a product.

    Days without movements are filled in first, so the trailing outbound runs
    down between movements. A product without a reorder point is never low.
    """
    by_day = Window.partitionBy("product_id").orderBy("day")
    moves = daily_movements(log).withColumn("_next", F.date_sub(F.lead("day").over(by_day), 1))
    days = moves.withColumn("_day", F.explode(F.sequence("day", F.coalesce("_next", "day"))))
    first = F.col("_day") == F.col("day")
    filled = days.select(
        "product_id",
        F.col("_day").alias("day"),
        F.unix_date("_day").alias("_n"),
        F.when(first, F.col("change")).otherwise(0).alias("change"),
        F.when(first, F.col("outbound")).otherwise(0).alias("outbound"),
    )
    by_number = Window.partitionBy("product_id").orderBy("_n")
    measured = filled.select(
        "product_id",
        "day",
        F.sum("change").over(by_number.rowsBetween(Window.unboundedPreceding, 0)).alias("quantity"),
        F.sum("outbound").over(by_number.rangeBetween(1 - trailing_days, 0)).alias("outbound"),
    )
    supply = (F.col("quantity") * trailing_days).cast("decimal(24,6)") / F.nullif("outbound", F.lit(0)).cast("decimal(18,0)")
    return measured.join(reorder_points, "product_id", "left").select(
        dates.date_key("day").alias("snapshot_date_key"),
        F.col("product_id").alias("product_key"),
        F.col("quantity").cast("bigint").alias("current_quantity"),
        F.coalesce(is_low_stock(), F.lit(False)).alias("is_low_stock"),
        F.round(supply, 4).cast("decimal(18,4)").alias("days_of_supply"),
    )


def outbound_from_sales(items: DataFrame) -> DataFrame:
    """Stock movements that the order lines cause."""
    return items.select(
        "order_id",
        "product_id",
        (-F.col("quantity")).cast("bigint").alias("change_quantity"),
        F.lit("outbound").alias("log_type"),
        F.concat(F.lit("ขายผ่านคำสั่งซื้อ #"), F.col("order_id").cast("string")).alias("reason"),
    )


def oversell_report(demand: DataFrame, stock: DataFrame, order: list[str], day: str = "order_date") -> DataFrame:
    """First order line per product at which demand so far exceeds the stock.

    Daily totals find the day of the breach; only that day's lines are then
    walked one by one, so most lines are read once and never sorted. ``order``
    is the total order of a product's lines within a day and holds ``order_id``.
    """
    daily = demand.groupBy("product_id", F.col(day).alias("_day")).agg(
        F.sum("quantity").alias("_ordered")
    )
    by_day = Window.partitionBy("product_id").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    so_far = daily.withColumn("_so_far", F.sum("_ordered").over(by_day)).join(stock, "product_id")
    over = so_far.filter(F.col("_so_far") > F.col("stock"))
    breach = over.groupBy("product_id", "stock").agg(
        F.min(F.struct("_day", (F.col("_so_far") - F.col("_ordered")).alias("_before"))).alias("_first")
    )
    days = breach.select(
        "product_id", "stock", F.col("_first._day").alias(day), F.col("_first._before").alias("_before")
    )
    lines = demand.join(days, ["product_id", day])
    walked = running_total(lines, ["product_id"], order, "quantity", "_here")
    reached = walked.withColumn("demand", (F.col("_before") + F.col("_here")).cast("bigint")).filter("demand > stock")
    first = F.min(F.struct(*order, "demand")).alias("_line")
    return reached.groupBy("product_id", "stock").agg(first).select(
        "product_id", "stock", F.col("_line.order_id").alias("order_id"), F.col("_line.demand").alias("demand")
    )
