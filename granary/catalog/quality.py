"""Data-quality rules over the sample tables with planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.catalog.registry import query
from granary.contracts import (
    DISCOUNT_TYPES,
    ORDER_STATUS,
    PAYMENT_METHODS,
    SHIPMENT_STATUS,
    STOCK_LOG_TYPES,
    coupon_table,
)
from granary.operators import quality
from granary.plans import northwind, pricing
from granary.sources import sample


def _known_products(spark, folder):
    return sample.products(spark, folder).filter("product_id % 7 <> 0")


@query(
    "dq_missing_key",
    """SELECT 'missing_key' AS rule, 'customers' AS table_name, company_name AS key, 'missing customer_id' AS detail
       FROM people WHERE customer_id % 11 IN (0, 1)""",
)
def dq_missing_key(spark, folder):
    """Customers whose key was blanked: NULL for some, empty text for others."""
    number = F.col("customer_id")
    blanked = F.when(number % 11 == 1, "").when(number % 11 != 0, number.cast("string"))
    customers = sample.customers(spark, folder).withColumn("customer_id", blanked)
    return quality.missing_key(customers, "customers", "customer_id", F.col("company_name"))


@query(
    "dq_conflicting_duplicates",
    """SELECT 'conflicting_duplicate' AS rule, 'customers' AS table_name, CAST(customer_id AS VARCHAR) AS key,
              'conflicting customer_id' AS detail
       FROM people WHERE customer_id % 13 = 0""",
)
def dq_conflicting_duplicates(spark, folder):
    """Exact copies are fine; copies with another name are not."""
    customers = sample.customers(spark, folder)
    renamed = customers.filter("customer_id % 13 = 0").withColumn("company_name", F.concat("company_name", F.lit(" Ltd")))
    copies = customers.filter("customer_id % 5 = 0")
    arrived = customers.unionByName(renamed).unionByName(copies)
    return quality.conflicting_duplicates(arrived, "customers", "customer_id")


@query(
    "dq_empty_tables",
    """SELECT 'empty_table' AS rule, 'returns' AS table_name, 'returns' AS key, 'no rows' AS detail
       FROM (SELECT count(*) AS n FROM lines WHERE quantity < 0) WHERE n = 0""",
)
def dq_empty_tables(spark, folder):
    tables = {
        "customers": sample.customers(spark, folder),
        "products": sample.products(spark, folder),
        "orders": sample.orders(spark, folder),
        "order_details": sample.order_details(spark, folder),
        "returns": sample.order_details(spark, folder).filter("quantity < 0"),
    }
    return quality.union_all(quality.empty_table(df, name) for name, df in tables.items())


@query(
    "dq_orphans",
    """SELECT 'orphan' AS rule, 'orders' AS table_name, CAST(order_id AS VARCHAR) AS key,
              'customer_id=' || customer_id AS detail FROM heads WHERE customer_id % 7 = 0
       UNION ALL SELECT 'orphan', 'orders', CAST(order_id AS VARCHAR), 'shipper_id=' || shipper_id
       FROM heads WHERE shipper_id % 7 = 0
       UNION ALL SELECT 'orphan', 'order_details', order_id || '/' || line_number, 'order_id=' || order_id
       FROM lines WHERE order_id % 7 = 0
       UNION ALL SELECT 'orphan', 'order_details', order_id || '/' || line_number, 'product_id=' || product_id
       FROM lines WHERE product_id % 7 = 0""",
)
def dq_orphans(spark, folder):
    """Every parent table lost each seventh key."""
    orders = sample.orders(spark, folder)
    details = sample.lines(spark, folder).select("order_id", "line_number", "product_id")
    label = F.concat_ws("/", F.col("order_id").cast("string"), F.col("line_number").cast("string"))
    known_orders = orders.filter("order_id % 7 <> 0")
    return quality.union_all(
        [
            quality.orphans(orders, sample.customers(spark, folder).filter("customer_id % 7 <> 0"), "orders",
                            "order_id", "customer_id", "customer_id"),
            quality.orphans(orders, sample.shippers(spark, folder).filter("shipper_id % 7 <> 0"), "orders",
                            "order_id", "shipper_id", "shipper_id"),
            quality.orphans(details, known_orders, "order_details", label, "order_id", "order_id"),
            quality.orphans(details, _known_products(spark, folder), "order_details", label, "product_id", "product_id"),
        ]
    )


@query(
    "accepted_lines",
    "SELECT order_id, product_id, unit_price, quantity, discount FROM lines WHERE product_id % 7 <> 0",
)
def accepted_lines(spark, folder):
    details = sample.order_details(spark, folder)
    accepted = quality.accepted_by(details, _known_products(spark, folder), "product_id", "product_id")
    return accepted.select(*sample.DETAIL_COLUMNS)


@query(
    "dq_measures",
    """SELECT 'negative_freight' AS rule, 'orders' AS table_name, CAST(order_id AS VARCHAR) AS key,
              'freight' AS detail FROM heads WHERE freight - 200000 < 0
       UNION ALL SELECT 'measure_range', 'order_details', CAST(order_id AS VARCHAR), 'quantity'
       FROM lines WHERE quantity - 5 <= 0
       UNION ALL SELECT 'measure_range', 'order_details', CAST(order_id AS VARCHAR), 'unit_price'
       FROM lines WHERE unit_price - 1000 < 0
       UNION ALL SELECT 'measure_range', 'order_details', CAST(order_id AS VARCHAR), 'discount'
       FROM lines WHERE discount + 0.95 > 1""",
)
def dq_measures(spark, folder):
    """Measures shifted so that some leave their range."""
    orders = sample.orders(spark, folder).withColumn("freight", F.expr("freight - 200000"))
    details = sample.order_details(spark, folder).withColumns(
        {
            "quantity": F.expr("quantity - 5"),
            "unit_price": F.expr("unit_price - 1000"),
            "discount": F.expr("discount + 0.95BD"),
        }
    )
    return quality.negative_freight(orders).unionByName(quality.measure_rules(details, "order_id"))


@query(
    "northwind_gate",
    """SELECT 'invalid_number' AS rule, 'order_details' AS table_name,
              CAST(order_id * 10 + line_number AS VARCHAR) AS key, 'quantity=' || quantity || '.7' AS detail
       FROM lines WHERE order_id % 31 = 1
       UNION ALL SELECT 'required', 'order_details', CAST(order_id * 10 + line_number AS VARCHAR), 'unit_price= '
       FROM lines WHERE order_id % 37 = 2
       UNION ALL SELECT 'invalid_date', 'orders', CAST(order_id AS VARCHAR), 'order_date=not a date'
       FROM heads WHERE order_id % 41 = 3
       UNION ALL SELECT 'required', 'orders', CAST(order_id AS VARCHAR), 'order_date=null'
       FROM heads WHERE order_id % 41 = 4
       UNION ALL SELECT 'invalid_number', 'products', CAST(product_id AS VARCHAR), 'unit_price=12.345'
       FROM products WHERE product_id % 43 = 5""",
)
def northwind_gate(spark, folder):
    """Source texts that do not fit the contract: broken whole numbers, bad dates, gaps, too many decimals."""
    def text_of(df, **changes):
        return df.select([F.col(name).cast("string").alias(name) for name in df.columns]).withColumns(changes)

    def where(condition, value, name):
        return F.when(F.expr(condition), value).otherwise(F.col(name))

    details = sample.lines(spark, folder).withColumn("line_id", F.expr("order_id * 10 + line_number"))
    details = details.select("line_id", *sample.DETAIL_COLUMNS)
    raw = {
        "customers": text_of(sample.customers(spark, folder)),
        "products": text_of(
            sample.products(spark, folder).drop("cost"), unit_price=where("product_id % 43 = 5", "12.345", "unit_price")
        ),
        "orders": text_of(
            sample.orders(spark, folder),
            order_date=F.when(F.expr("order_id % 41 = 3"), "not a date").when(F.expr("order_id % 41 <> 4"), F.col("order_date")),
        ),
        "order_details": text_of(
            details,
            quantity=where("order_id % 31 = 1", F.concat("quantity", F.lit(".7")), "quantity"),
            unit_price=where("order_id % 37 = 2", " ", "unit_price"),
        ),
        "shippers": text_of(sample.shippers(spark, folder)),
    }
    return northwind.unreadable(raw)


@query(
    "dq_accepted_values",
    """SELECT 'accepted_values' AS rule, 'orders' AS table_name, CAST(order_id AS VARCHAR) AS key,
              'order_status=lost' AS detail FROM headers WHERE order_id % 17 = 0
       UNION ALL SELECT 'accepted_values', 'shipments', CAST(shipment_id AS VARCHAR), 'status=null'
       FROM parcels WHERE shipment_id % 19 = 0
       UNION ALL SELECT 'accepted_values', 'stock_logs', CAST(log_id AS VARCHAR), 'log_type=outbound '
       FROM log WHERE log_type = 'outbound' AND log_id % 23 = 0
       UNION ALL SELECT 'accepted_values', 'orders', CAST(order_id AS VARCHAR), 'payment_method=cash'
       FROM headers WHERE order_id % 29 = 0
       UNION ALL SELECT 'accepted_values', 'applied_coupons', CAST(order_id AS VARCHAR), 'discount_type=Fixed'
       FROM eligible WHERE discount_type = 'fixed' AND order_id % 3 = 0""",
)
def dq_accepted_values(spark, folder):
    orders = sample.order_header(spark, folder).withColumns(
        {
            "order_status": F.when(F.col("order_id") % 17 == 0, "lost").otherwise(F.col("order_status")),
            "payment_method": F.when(F.col("order_id") % 29 == 0, "cash").otherwise(F.col("payment_method")),
        }
    )
    baskets = pricing.baskets(sample.order_items(spark, folder), sample.order_header(spark, folder))
    capital = (F.col("discount_type") == "fixed") & (F.col("order_id") % 3 == 0)
    coupons = pricing.eligible_coupons(baskets, coupon_table(spark)).withColumn(
        "discount_type", F.when(capital, "Fixed").otherwise(F.col("discount_type"))
    )
    shipments = sample.shipments(spark, folder).withColumn(
        "status", F.when(F.col("shipment_id") % 19 != 0, F.col("status"))
    )
    spoilt = (F.col("log_type") == "outbound") & (F.col("log_id") % 23 == 0)
    log = sample.stock_log(spark, folder).withColumn(
        "log_type", F.when(spoilt, "outbound ").otherwise(F.col("log_type"))
    )
    return quality.union_all(
        [
            quality.not_accepted(orders, "orders", "order_id", "order_status", ORDER_STATUS),
            quality.not_accepted(shipments, "shipments", "shipment_id", "status", SHIPMENT_STATUS),
            quality.not_accepted(log, "stock_logs", "log_id", "log_type", STOCK_LOG_TYPES),
            quality.not_accepted(orders, "orders", "order_id", "payment_method", PAYMENT_METHODS),
            quality.not_accepted(coupons, "applied_coupons", "order_id", "discount_type", DISCOUNT_TYPES),
        ]
    )


@query(
    "dq_unique_keys",
    """SELECT 'already_exists' AS rule, 'loyalty_accounts' AS table_name, CAST(c_custkey AS VARCHAR) AS key,
              'phone exists' AS detail
       FROM customer WHERE c_custkey IN (SELECT s_suppkey FROM supplier)
       UNION ALL SELECT 'duplicate_key', 'loyalty_accounts', CAST(c_custkey AS VARCHAR), 'rows=2'
       FROM customer WHERE c_custkey % 13 = 0""",
)
def dq_unique_keys(spark, folder):
    """New members whose phone is taken, or who come twice in one load."""
    new = sample.table(spark, folder, "customer").select(F.col("c_custkey").alias("phone"))
    incoming = new.unionByName(new.filter("phone % 13 = 0"))
    existing = sample.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("phone"))
    return quality.rejected_inserts(incoming, existing, "loyalty_accounts", "phone")


@query(
    "dq_rating_range",
    """SELECT 'rating_range' AS rule, 'ratings' AS table_name, CAST(event_id AS VARCHAR) AS key,
              'rating' AS detail FROM events WHERE value > 10 OR value < 0""",
)
def dq_rating_range(spark, folder):
    ratings = sample.ratings(spark, folder)
    return quality.outside(ratings, F.col("rating").between(0, 10), "rating_range", "ratings", "event_id", "rating")
