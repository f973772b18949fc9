"""Shipments, carriers and tracking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import dates, text
from granary.operators import file_index
from granary.operators.ordering import dense_number


def progress(status: str = "status") -> Column:
    """Percent of the way a shipment has come."""
    value = F.col(status)
    return (
        F.when(value == "preparing", 0).when(value == "shipping", 40).when(value == "delivered", 80).otherwise(0)
    ).cast("bigint")


def status_counts(shipments: DataFrame) -> DataFrame:
    """Total and per-status counts in one pass."""
    return shipments.agg(
        F.count("*").alias("total_shipments"),
        F.count_if(F.col("status") == "preparing").alias("preparing_count"),
        F.count_if(F.col("status") == "shipping").alias("shipping_count"),
        F.count_if(F.col("status") == "delivered").alias("delivered_count"),
    )


def board(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    """Shipments with the order they belong to."""
    header = orders.select("order_id", "customer_id", "order_status")
    return shipments.join(header, "order_id").select(
        "order_id", "customer_id", "order_status", "tracking_number", "carrier", "shipping_cost", "status",
        "updated_at", progress().alias("progress"),
    )


def order_detail(shipments: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Shipped order lines with product name and subtotal, one flat row each."""
    head = shipments.select("order_id", "tracking_number", "status")
    names = products.select("product_id", "product_name")
    return (
        items.join(head, "order_id")
        .join(names, "product_id")
        .select(
            "tracking_number", "order_id", "status", "product_name", "price", "quantity",
            (F.col("price") * F.col("quantity")).cast("decimal(18,2)").alias("subtotal"),
        )
    )


def tracking_lookup(requests: DataFrame, shipments: DataFrame) -> DataFrame:
    """Find shipments for typed-in tracking numbers, ignoring case and padding.

    The batch form of a lookup: both sides are normalised and joined on equality.
    """
    known = shipments.select(
        F.lower("tracking_number").alias("_key"), "tracking_number", "order_id", "status", "carrier"
    )
    return _asked(requests).join(known, "_key").drop("_key")


def _asked(requests: DataFrame) -> DataFrame:
    return requests.withColumn("_key", F.lower(text.strip_whitespace("query"))).filter("_key <> ''")


def index_tracking(spark: SparkSession, path: str, index: str) -> int:
    """Bring the index of a published shipments table up to date; the number of files that were new."""
    return file_index.update(spark, path, index, F.lower("tracking_number"))


def indexed_lookup(spark: SparkSession, requests: DataFrame, path: str, index: str) -> DataFrame:
    """The same lookup over a published table, opening only files that may hold a number asked for."""
    return tracking_lookup(requests, file_index.pruned(spark, path, index, _asked(requests), "_key"))


def sync_order_status(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Orders whose shipment is delivered become shipped; others keep their status."""
    delivered = shipments.filter(F.col("status") == "delivered").select("order_id", F.lit(True).alias("_delivered"))
    return orders.join(delivered, "order_id", "left").select(
        "order_id",
        F.col("order_status").alias("old_status"),
        F.when(F.col("_delivered"), "shipped").otherwise(F.col("order_status")).alias("new_status"),
    )


def shipments_from_orders(orders: DataFrame) -> DataFrame:
    """Shipments that paid and shipped orders call for."""
    status = F.when(F.col("order_status") == "paid", "delivered").when(F.col("order_status") == "shipped", "shipping")
    return orders.withColumn("status", status).filter("status is not null")


def dim_carrier(shipments: DataFrame) -> DataFrame:
    """Carriers in use, numbered by name."""
    names = shipments.select(F.col("carrier").alias("carrier_name")).distinct()
    return dense_number(names, ["carrier_name"], "carrier_key").select("carrier_key", "carrier_name")


def fact_logistics(shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    named = carriers.withColumnRenamed("carrier_name", "carrier")
    return shipments.join(named, "carrier", "left").select(
        "shipment_id",
        dates.date_key("updated_at").alias("date_key"),
        "carrier_key",
        F.col("status").alias("shipment_status"),
        "shipping_cost",
    )
