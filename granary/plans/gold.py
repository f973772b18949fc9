"""Gold layer: star schemas for the order files and for the Northwind set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.contracts import DAYS_TH, MONTHS_TH, PAYMENT_LABELS, PRICE
from granary.functions import dates, numbers, text
from granary.operators.ordering import dense_number


# ------------------------------------------------------------------ calendars
def dim_date(df: DataFrame, day: str = "order_date") -> DataFrame:
    days = df.select(F.col(day).alias("full_date")).filter("full_date is not null").distinct()
    return days.select(
        dates.date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").cast("bigint").alias("year"),
        F.quarter("full_date").cast("bigint").alias("quarter"),
        F.month("full_date").cast("bigint").alias("month"),
        dates.is_weekend("full_date").alias("is_weekend"),
    )


def dim_date_thai(df: DataFrame, day: str = "order_date") -> DataFrame:
    """The calendar with Thai month and day names and the fiscal year."""
    return dim_date(df, day).select(
        "*",
        text.labelled(F.month("full_date"), MONTHS_TH).alias("month_name_th"),
        text.labelled(F.dayofweek("full_date"), DAYS_TH).alias("day_name_th"),
        dates.thai_fiscal_year("full_date").alias("fiscal_year"),
    )


def dim_date_iso(df: DataFrame, day: str = "order_date") -> DataFrame:
    days = df.select(F.col(day).alias("order_date")).distinct()
    return days.select(
        "order_date",
        F.year("order_date").cast("bigint").alias("year"),
        F.month("order_date").cast("bigint").alias("month"),
        dates.iso_week("order_date").alias("iso_week"),
        dates.iso_year("order_date").alias("iso_year"),
    )


# ------------------------------------------------- star over the order files
CUSTOMER_ATTRIBUTES = ["customer_name", "customer_email", "customer_phone", "province"]


def dim_customer(silver: DataFrame) -> DataFrame:
    """Orders and spending per customer and attribute combination."""
    return silver.groupBy(F.col("customer_id").alias("customer_key"), *CUSTOMER_ATTRIBUTES).agg(
        F.count("*").alias("total_orders"), numbers.total("total_amount").alias("total_spent")
    )


def dim_product(silver: DataFrame) -> DataFrame:
    """Highest price seen per product and attribute combination."""
    return silver.groupBy(F.col("product_id").alias("product_key"), "product_name", "category").agg(
        F.max("unit_price").alias("current_price")
    )


def dim_product_latest(lines: DataFrame, recency: list[str]) -> DataFrame:
    """Price of the most recent sale per product."""
    latest = F.max_by("unit_price", F.struct(*recency))
    return lines.groupBy(F.col("product_id").alias("product_key")).agg(latest.alias("current_price"))


def dim_payment(silver: DataFrame) -> DataFrame:
    return silver.select(F.col("payment_method").alias("payment_key"), "payment_method").distinct()


def dim_payment_labelled(orders: DataFrame) -> DataFrame:
    """Payment methods in use, numbered by name, with their Thai labels."""
    methods = orders.select("payment_method").distinct()
    numbered = dense_number(methods, ["payment_method"], "payment_key")
    return numbered.select(
        "payment_key",
        "payment_method",
        text.labelled("payment_method", PAYMENT_LABELS).alias("payment_label"),
    )


def fact_sales_local(silver: DataFrame) -> DataFrame:
    """Sales measures of the order files; the source's own total is the revenue."""
    return silver.select(
        dates.date_key("order_date").alias("date_key"),
        "order_id",
        F.col("product_id").alias("product_key"),
        F.col("customer_id").alias("customer_key"),
        F.col("payment_method").alias("payment_key"),
        "quantity",
        "unit_price",
        numbers.line_total("quantity", "unit_price").alias("line_total"),
        numbers.percent_discount("quantity", "unit_price", "discount_pct").alias("discount_amount"),
        numbers.money(F.col("total_amount")).alias("net_revenue"),
        "shipping_status",
    )


def with_sale_key(fact: DataFrame, order: tuple[str, ...] = ("order_id", "product_key")) -> DataFrame:
    """Gap-free surrogate key along a total order of the fact rows."""
    return dense_number(fact, list(order), "sale_key")


def build(silver: DataFrame) -> dict[str, DataFrame]:
    """All tables of the order-file star schema."""
    return {
        "dim_date": dim_date(silver),
        "dim_customer": dim_customer(silver),
        "dim_product": dim_product(silver),
        "dim_payment": dim_payment(silver),
        "fact_sales": with_sale_key(fact_sales_local(silver)),
    }


# ------------------------------------------------------ star over Northwind
def fact_sales(details: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with customer, day and shipper of their order."""
    header = orders.select("order_id", "customer_id", "order_date", "shipper_id")
    return details.join(header, "order_id").withColumn(
        "net_revenue", numbers.net_revenue("quantity", "unit_price", "discount")
    )


def fact_orders(orders: DataFrame) -> DataFrame:
    """Order grain: freight is taxed once per order, never per line."""
    return orders.withColumn("freight_including_vat", numbers.with_vat("freight"))


def sales_dashboard(fact: DataFrame, products: DataFrame, customers: DataFrame, shippers: DataFrame) -> DataFrame:
    """The published view: sales with product, city and shipper.

    No broadcast hints: Spark broadcasts a dimension when its measured size
    allows and otherwise sorts and merges, splitting skewed partitions.
    """
    return (
        fact.join(products.select("product_id", "product_name", "category_id"), "product_id")
        .join(customers.select("customer_id", "city"), "customer_id")
        .join(shippers.select("shipper_id", "shipper_name"), "shipper_id")
    )


# ------------------------------------------------------ documented extensions
def with_profit(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Unit cost and gross profit per line; both NULL for a product without a cost."""
    costs = products.select("product_id", F.col("cost").alias("unit_cost"))
    profit = numbers.money(F.col("net_revenue") - F.col("quantity") * F.col("unit_cost"))
    return fact.join(costs, "product_id", "left").withColumn("gross_profit", profit)


def product_margin(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "unit_price", "cost", numbers.profit_margin("unit_price", "cost").alias("profit_margin")
    )


def with_surrogates(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Replace natural keys by surrogate keys; an unknown member stays NULL.

    ``dims`` maps a natural key column to (dimension, its natural key, its
    surrogate key).
    """
    for column, (dim, natural, surrogate) in dims.items():
        fact = fact.join(dim.select(F.col(natural).alias(column), surrogate), column, "left").drop(column)
    return fact


def documented_product(products: DataFrame) -> DataFrame:
    """``product_key, sku, product_name, current_price, current_cost, profit_margin`` and the natural key."""
    columns = products.select(
        "product_id",
        "sku",
        "product_name",
        F.col("unit_price").cast(PRICE).alias("current_price"),
        F.col("cost").cast(PRICE).alias("current_cost"),
        numbers.profit_margin("unit_price", "cost").alias("profit_margin"),
    )
    return keyed(columns, "product_id", "product_key")


def documented_sales(
    lines: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame, payments: DataFrame,
    order: tuple[str, ...],
) -> DataFrame:
    """Sales at line grain with the keys of all dimensions, cost, discount and gross profit.

    ``order`` totally orders the lines for ``sale_id``. A line whose product
    has no cost, or whose member is unknown, stays with NULL there.
    """
    header = orders.select("order_id", "customer_id", "order_date", "payment_method")
    costs = products.select("product_id", "product_key", F.col("cost").alias("unit_cost"))
    total = numbers.line_total("quantity", "unit_price")
    joined = (
        dense_number(lines, list(order), "sale_id")
        .join(header, "order_id")
        .join(costs, "product_id", "left")
        .join(customers.select("customer_id", "customer_key"), "customer_id", "left")
        .join(payments.select("payment_method", "payment_key"), "payment_method", "left")
        .withColumn("net_revenue", numbers.net_revenue("quantity", "unit_price", "discount"))
    )
    return joined.select(
        "sale_id",
        dates.date_key("order_date").alias("date_key"),
        "order_id",
        "product_key",
        "customer_key",
        "payment_key",
        "quantity",
        "unit_price",
        "unit_cost",
        total.alias("line_total"),
        numbers.money(total - F.col("net_revenue")).alias("discount_amount"),
        "net_revenue",
        numbers.money(F.col("net_revenue") - F.col("quantity") * F.col("unit_cost")).alias("gross_profit"),
    )


def keyed(dim: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """A dimension numbered 1..n by its natural key."""
    return dense_number(dim, [natural], surrogate)
