"""Dashboard metrics over the published sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.contracts import MONEY

# the saved charts ask for at most this many rows
CHART_ROW_LIMIT = 10_000


def metric(name: str) -> Column:
    """A named dataset metric."""
    if name == "revenue":
        return F.sum("net_revenue").cast(MONEY).alias("revenue")
    if name == "orders":
        return F.count_distinct("order_id").alias("orders")
    if name == "units":
        return F.sum("quantity").cast("bigint").alias("units")
    raise KeyError(name)


def chart(sales: DataFrame, name: str, columns: tuple[str, ...] = (), grain: str | None = None,
          limit: int | None = None) -> DataFrame:
    """One metric by columns and, optionally, by day, week, month or year.

    Highest values first; ties go by the grouping columns, so that a row limit
    the caller passes always cuts at the same place.
    """
    groups = [F.col(c) for c in columns]
    if grain:
        groups.append(F.date_trunc(grain, "order_date").cast("date").alias("order_date"))
    if not groups:
        return sales.agg(metric(name))
    ties = [*columns, *(["order_date"] if grain else [])]
    ranked = sales.groupBy(*groups).agg(metric(name)).orderBy(F.desc(name), *ties)
    return ranked if limit is None else ranked.limit(limit)


def net_revenue(sales: DataFrame) -> DataFrame:
    return chart(sales, "revenue")


def orders_with_sales(sales: DataFrame) -> DataFrame:
    return chart(sales, "orders")


def units_sold(sales: DataFrame) -> DataFrame:
    return chart(sales, "units")


def daily_revenue(sales: DataFrame) -> DataFrame:
    return chart(sales, "revenue", grain="day")


def revenue_by_attribute(
    sales: DataFrame, dim: DataFrame, key: str, attribute: str, limit: int | None = None
) -> DataFrame:
    """Revenue by a dimension attribute, summed by key before the join.

    Sums add up, so the sales shrink to one row per key map-side and only
    those rows meet the dimension; a hot key never reaches the join.
    """
    by_key = sales.groupBy(key).agg(F.sum("net_revenue").alias("net_revenue"))
    return chart(by_key.join(dim.select(key, attribute), key), "revenue", (attribute,), limit=limit)


def revenue_by_shipper(sales: DataFrame, shippers: DataFrame) -> DataFrame:
    return revenue_by_attribute(sales, shippers, "shipper_id", "shipper_name")


def top_products(sales: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    return revenue_by_attribute(sales, products, "product_id", "product_name", n)
