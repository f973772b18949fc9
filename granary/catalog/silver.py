"""Cleaning, typing, deduplication and the star over the order files."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.catalog.registry import query
from granary.functions import numbers
from granary.operators import quality
from granary.operators.dedup import dedup_first
from granary.operators.ordering import dense_number
from granary.plans import gold, silver
from granary.sources import sample

TEXT_COLUMNS = [
    "order_id", "customer_name", "customer_email", "customer_phone", "product_name", "category",
    "payment_method", "shipping_status", "province",
]
SILVER_COLUMNS = [
    "order_id", "order_date", "customer_id", "customer_name", "customer_email", "customer_phone", "product_id",
    "product_name", "category", "quantity", "unit_price", "discount_pct", "payment_method", "shipping_status",
    "province", "total_amount", "source_file",
]


def silver_orders_frame(spark, folder):
    """Silver table with one row per order; duplicates go before the wide rows are put together."""
    raw = sample.customer_orders(spark, folder, sample.first_lines(spark, folder))
    return silver.typed(silver.cleaned(silver.with_key(raw))).select(*SILVER_COLUMNS)


@query("silver_build", "SELECT * FROM silver")
def silver_build(spark, folder):
    """The same table by the run's own order of steps: wide rows first, then deduplication."""
    raw = sample.customer_orders(spark, folder)
    return silver.build(raw, ("order_id",), tuple(sample.BRONZE_ORDER)).select(*SILVER_COLUMNS)


@query(
    "silver_clean",
    """SELECT order_id, trim(customer_name) AS customer_name, lower(trim(customer_email)) AS customer_email,
              trim(customer_phone) AS customer_phone, trim(product_name) AS product_name, trim(category) AS category,
              trim(payment_method) AS payment_method, trim(shipping_status) AS shipping_status,
              trim(province) AS province
       FROM raw WHERE nullif(trim(order_id), '') IS NOT NULL""",
)
def silver_clean(spark, folder):
    return silver.cleaned(silver.with_key(sample.customer_orders(spark, folder))).select(*TEXT_COLUMNS)


@query(
    "silver_typed",
    """SELECT order_id, line_number, try_cast(order_date AS DATE) AS order_date,
              CAST(trunc(try_cast(trim(quantity) AS DECIMAL(38,6))) AS BIGINT) AS quantity,
              try_cast(unit_price AS DECIMAL(18,2)) AS unit_price,
              try_cast(discount_pct AS DECIMAL(7,4)) AS discount_pct,
              try_cast(total_amount AS DECIMAL(18,2)) AS total_amount
       FROM damaged""",
)
def silver_typed(spark, folder):
    return silver.typed(sample.damaged_orders(spark, folder)).select(
        "order_id", "line_number", "order_date", "quantity", "unit_price", "discount_pct", "total_amount"
    )


@query(
    "silver_rejects",
    """SELECT at_order_id, 'quantity' AS field, quantity AS value FROM damaged WHERE line_number = 2
       UNION ALL SELECT at_order_id, 'unit_price', unit_price FROM damaged WHERE line_number IN (4, 5)
       UNION ALL SELECT at_order_id, 'order_date', order_date FROM damaged WHERE line_number = 7""",
)
def silver_rejects(spark, folder):
    return silver.cast_rejects(sample.damaged_orders(spark, folder), "at_order_id")


@query(
    "dq_invalid_number",
    """SELECT 'invalid_number' AS rule, 'customer_orders' AS table_name, CAST(at_order_id AS VARCHAR) AS key,
              'unit_price=' || unit_price AS detail
       FROM damaged WHERE line_number IN (4, 5)
       UNION ALL SELECT 'invalid_number', 'customer_orders', CAST(at_order_id AS VARCHAR), 'quantity=' || quantity
       FROM damaged WHERE line_number = 2
       UNION ALL SELECT 'overprecise', 'customer_orders', CAST(at_order_id AS VARCHAR), 'unit_price=' || unit_price
       FROM damaged WHERE line_number = 6""",
)
def dq_invalid_number(spark, folder):
    """Unreadable numbers and prices with more than two decimals, in one pass."""
    def entry(rule, name, bad):
        detail = F.concat(F.lit(f"{name}="), F.col(name))
        return F.when(bad, F.struct(F.lit(rule).alias("rule"), detail.alias("detail")))

    checks = F.array(
        entry("invalid_number", "unit_price", numbers.is_bad_number("unit_price")),
        entry("invalid_number", "quantity", numbers.is_bad_number("quantity", "decimal(38,6)")),
        entry("overprecise", "unit_price", numbers.is_overprecise("unit_price")),
    )
    rows = sample.damaged_orders(spark, folder).withColumn("_bad", F.explode(F.filter(checks, lambda c: c.isNotNull())))
    return rows.select(
        "_bad.rule", F.lit("customer_orders").alias("table_name"), F.col("at_order_id").cast("string").alias("key"),
        "_bad.detail",
    )


@query(
    "dedup_first_order",
    """SELECT order_id, product_id, line_number, source_file FROM (
           SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY source_file, bronze_id) AS rank
           FROM raw WHERE trim(order_id) <> '') WHERE rank = 1""",
)
def dedup_first_order(spark, folder):
    raw = silver.with_key(sample.customer_orders(spark, folder))
    first = dedup_first(raw, ["order_id"], sample.BRONZE_ORDER)
    return first.select("order_id", "product_id", "line_number", "source_file")


@query(
    "dedup_first_line",
    """SELECT order_id, line_number, product_id, source_file FROM (
           SELECT *, row_number() OVER (PARTITION BY order_id, line_number ORDER BY source_file, bronze_id) AS rank
           FROM raw WHERE trim(order_id) <> '') WHERE rank = 1""",
)
def dedup_first_line(spark, folder):
    """Chosen by number: file and line are the same for all rows of a key, so the least product decides."""
    keys = ["at_order_id", "line_number"]
    raw = silver.with_key(sample.customer_orders(spark, folder))
    first = raw.groupBy(*keys).agg(F.min("at_product_id").alias("product"))
    return first.select(
        sample.order_code("at_order_id").alias("order_id"),
        "line_number",
        sample.product_code("product").alias("product_id"),
        sample.landing_file().alias("source_file"),
    )


@query("silver_customer_orders", "SELECT * FROM silver")
def silver_customer_orders(spark, folder):
    return silver_orders_frame(spark, folder)


# --------------------------------------------------------------- star schema
@query(
    "dim_date",
    """SELECT DISTINCT CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, order_date AS full_date,
              CAST(year(order_date) AS BIGINT) AS year, CAST(quarter(order_date) AS BIGINT) AS quarter,
              CAST(month(order_date) AS BIGINT) AS month, dayofweek(order_date) IN (0, 6) AS is_weekend
       FROM silver WHERE order_date IS NOT NULL""",
)
def dim_date(spark, folder):
    return gold.dim_date(silver_orders_frame(spark, folder))


@query(
    "dim_customer",
    """SELECT customer_id AS customer_key, customer_name, customer_email, customer_phone, province,
              count(*) AS total_orders, CAST(round(sum(total_amount), 2) AS DECIMAL(18,2)) AS total_spent
       FROM silver GROUP BY ALL""",
)
def dim_customer(spark, folder):
    return gold.dim_customer(silver_orders_frame(spark, folder))


@query(
    "dim_product",
    """SELECT product_id AS product_key, product_name, category, max(unit_price) AS current_price
       FROM silver GROUP BY ALL""",
)
def dim_product(spark, folder):
    return gold.dim_product(silver_orders_frame(spark, folder))


@query("dim_payment", "SELECT DISTINCT payment_method AS payment_key, payment_method FROM silver")
def dim_payment(spark, folder):
    return gold.dim_payment(silver_orders_frame(spark, folder))


@query(
    "fact_sales_local",
    """SELECT row_number() OVER (ORDER BY order_id, product_id) AS sale_key,
              CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, order_id, product_id AS product_key,
              customer_id AS customer_key, payment_method AS payment_key, quantity, unit_price,
              CAST(round(quantity * unit_price, 2) AS DECIMAL(18,2)) AS line_total,
              CAST(quantity * unit_price * discount_pct * 0.01 AS DECIMAL(18,2)) AS discount_amount,
              CAST(round(total_amount, 2) AS DECIMAL(18,2)) AS net_revenue, shipping_status
       FROM silver""",
)
def fact_sales_local(spark, folder):
    return gold.with_sale_key(gold.fact_sales_local(silver_orders_frame(spark, folder)))


@query(
    "dq_star_integrity",
    """SELECT 'duplicate_key' AS rule, 'dim_customer' AS table_name, CAST(customer_id AS VARCHAR) AS key,
              'rows=2' AS detail
       FROM people WHERE customer_id % 13 = 0
       UNION ALL
       SELECT 'orphan', 'fact_sales', CAST(order_id AS VARCHAR), 'product_id=' || product_id
       FROM lines WHERE product_id % 7 = 0
       UNION ALL
       SELECT 'missing_key', 'fact_sales', CAST(order_id AS VARCHAR), 'missing date_key' FROM heads
       WHERE order_id % 19 = 0""",
)
def dq_star_integrity(spark, folder):
    """Repeated dimension keys, unresolved and missing foreign keys."""
    customers = sample.customers(spark, folder)
    renamed = customers.filter("customer_id % 13 = 0").withColumn("company_name", F.lit("renamed"))
    known = sample.products(spark, folder).filter("product_id % 7 <> 0")
    dated = sample.orders(spark, folder).withColumn("date_key", F.when(F.col("order_id") % 19 != 0, F.col("order_date")))
    return quality.union_all(
        [
            quality.duplicate_keys(customers.unionByName(renamed), "dim_customer", "customer_id"),
            quality.orphans(
                sample.order_details(spark, folder), known, "fact_sales", "order_id", "product_id", "product_id"
            ),
            quality.missing_key(dated, "fact_sales", "date_key", F.col("order_id")),
        ]
    )


# ------------------------------------------------- documented silver and dims
@query(
    "silver_products",
    """SELECT product_id, sku, product_name, CAST(unit_price AS DECIMAL(10,2)) AS price,
              CAST(cost AS DECIMAL(10,2)) AS cost,
              CAST(CASE WHEN cents <> 0 THEN ((cents - cost_cents) * 20000 + cents) // (2 * cents) END * 0.0001
                   AS DECIMAL(10,4)) AS profit_margin
       FROM (SELECT p.*, b.p_brand || '-' || p.product_id AS sku, CAST(unit_price * 100 AS BIGINT) AS cents,
                    CAST(cost * 100 AS BIGINT) AS cost_cents
             FROM products p JOIN part b ON p.product_id = b.p_partkey)""",
)
def silver_products(spark, folder):
    price = F.col("p_retailprice").cast("decimal(18,2)")
    raw = sample.table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit(" "), "p_brand", F.lit("-"), F.col("p_partkey").cast("string"), F.lit("\t")).alias("sku"),
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("product_name"),
        price.alias("price"),
        (price * F.expr("0.7BD")).cast("decimal(18,2)").alias("cost"),
    )
    return silver.products(raw)


@query(
    "silver_orders",
    """SELECT h.order_id, c_name AS customer_name, 'user' || c_custkey || '@example.com' AS email, h.order_status,
              h.payment_method, CAST(strftime(h.order_date, '%Y%m%d') AS BIGINT) AS order_date_key
       FROM headers h JOIN customer ON h.customer_id = c_custkey""",
)
def silver_orders(spark, folder):
    people = sample.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("  "), "c_name").alias("customer_name"),
        F.concat(F.lit(" User"), F.col("c_custkey").cast("string"), F.lit("@Example.COM ")).alias("email"),
    )
    return silver.orders(sample.order_header(spark, folder).join(people, "customer_id"))


@query(
    "dim_payment_labelled",
    """SELECT row_number() OVER (ORDER BY payment_method) AS payment_key, payment_method,
              CASE payment_method WHEN 'credit' THEN 'บัตรเครดิต/เดบิต' WHEN 'promptpay' THEN 'QR PromptPay'
                   WHEN 'cod' THEN 'เก็บเงินปลายทาง (COD)' END AS payment_label
       FROM (SELECT DISTINCT payment_method FROM headers)""",
)
def dim_payment_labelled(spark, folder):
    return gold.dim_payment_labelled(sample.order_header(spark, folder))


@query(
    "dim_product_keyed",
    """SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name, unit_price
       FROM products""",
)
def dim_product_keyed(spark, folder):
    dim = sample.products(spark, folder).select("product_id", "product_name", "unit_price")
    return dense_number(dim, ["product_id"], "product_key").select("product_key", *dim.columns)
