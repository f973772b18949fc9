"""Star schema, published view, dashboard metrics and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.catalog.registry import query
from granary.functions import numbers
from granary.operators.dedup import dedup_exact
from granary.operators.quality import union_all
from granary.plans import gold, kpi, northwind, publish
from granary.session import stage
from granary.sources import sample


def _sales(spark, folder):
    return gold.fact_sales(sample.order_details(spark, folder), sample.orders(spark, folder))


# ------------------------------------------------------------ Northwind star
@query("fact_sales", "SELECT * FROM sales")
def fact_sales(spark, folder):
    return gold.fact_sales(sample.numbered_details(spark, folder), sample.orders(spark, folder))


@query("fact_orders", "SELECT *, CAST(round(freight * 1.07, 2) AS DECIMAL(18,2)) AS freight_including_vat FROM heads")
def fact_orders(spark, folder):
    return gold.fact_orders(sample.orders(spark, folder))


@query("dim_shipper", "SELECT * FROM shippers")
def dim_shipper(spark, folder):
    return sample.shippers(spark, folder)


@query("dim_product_nw", "SELECT product_id, product_name, category_id, unit_price FROM products")
def dim_product_nw(spark, folder):
    return sample.products(spark, folder).drop("cost")


@query("publish_public_customers", "SELECT * FROM people")
def publish_public_customers(spark, folder):
    return sample.customers(spark, folder)


@query(
    "dim_date_iso",
    """SELECT DISTINCT order_date, CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month,
              CAST(week(order_date) AS BIGINT) AS iso_week, CAST(isoyear(order_date) AS BIGINT) AS iso_year
       FROM heads""",
)
def dim_date_iso(spark, folder):
    return gold.dim_date_iso(sample.orders(spark, folder))


@query("sales_dashboard", "SELECT * EXCLUDE (line_id) FROM dashboard")
def sales_dashboard(spark, folder):
    """The published view; lines are numbered when they are loaded, not when they are read."""
    return gold.sales_dashboard(
        _sales(spark, folder),
        sample.products(spark, folder),
        sample.customers(spark, folder),
        sample.shippers(spark, folder),
    )


# ----------------------------------------------------------------- six charts
@query("kpi_net_revenue", "SELECT CAST(sum(net_revenue) AS DECIMAL(18,2)) AS revenue FROM dashboard")
def kpi_net_revenue(spark, folder):
    return kpi.net_revenue(_sales(spark, folder))


@query("kpi_orders", "SELECT count(DISTINCT order_id) AS orders FROM dashboard")
def kpi_orders(spark, folder):
    return kpi.orders_with_sales(_sales(spark, folder))


@query("kpi_units", "SELECT CAST(sum(quantity) AS BIGINT) AS units FROM dashboard")
def kpi_units(spark, folder):
    return kpi.units_sold(_sales(spark, folder))


@query(
    "daily_revenue",
    "SELECT order_date, CAST(sum(net_revenue) AS DECIMAL(18,2)) AS revenue FROM dashboard "
    "GROUP BY order_date ORDER BY revenue DESC, order_date",
)
def daily_revenue(spark, folder):
    return kpi.daily_revenue(_sales(spark, folder))


@query(
    "revenue_by_shipper",
    "SELECT shipper_name, CAST(sum(net_revenue) AS DECIMAL(18,2)) AS revenue FROM dashboard "
    "GROUP BY shipper_name ORDER BY revenue DESC, shipper_name",
)
def revenue_by_shipper(spark, folder):
    return kpi.revenue_by_shipper(_sales(spark, folder), sample.shippers(spark, folder))


@query(
    "top_products",
    "SELECT product_name, CAST(sum(net_revenue) AS DECIMAL(18,2)) AS revenue FROM dashboard "
    "GROUP BY product_name ORDER BY revenue DESC, product_name LIMIT 10",
)
def top_products(spark, folder):
    return kpi.top_products(_sales(spark, folder), sample.products(spark, folder))


@query(
    "chart_row_limit",
    "SELECT product_id, order_date, CAST(sum(net_revenue) AS DECIMAL(18,2)) AS revenue FROM dashboard "
    "GROUP BY ALL ORDER BY revenue DESC, product_id, order_date LIMIT 10000",
)
def chart_row_limit(spark, folder):
    """A chart with more groups than the chart's own row limit."""
    return kpi.chart(_sales(spark, folder), "revenue", ("product_id",), "day", kpi.CHART_ROW_LIMIT)


@query(
    "kpi_smoke",
    """SELECT 'Net Revenue (THB)' AS chart, CAST(1 AS BIGINT) AS rows FROM (SELECT count(*) FROM dashboard)
       UNION ALL SELECT 'Orders with Sales', 1 UNION ALL SELECT 'Units Sold', 1
       UNION ALL SELECT 'Daily Revenue', count(DISTINCT order_date) FROM dashboard
       UNION ALL SELECT 'Revenue by Shipper', count(DISTINCT shipper_name) FROM dashboard
       UNION ALL SELECT 'Top 10 Products', least(10, count(DISTINCT product_name)) FROM dashboard""",
)
def kpi_smoke(spark, folder):
    # six charts read the same narrow fact, so it is written once
    facts = stage(
        _sales(spark, folder).select("order_id", "product_id", "shipper_id", "order_date", "quantity", "net_revenue"),
        "kpi",
    )
    charts = {
        "Net Revenue (THB)": kpi.net_revenue(facts),
        "Orders with Sales": kpi.orders_with_sales(facts),
        "Units Sold": kpi.units_sold(facts),
        "Daily Revenue": kpi.daily_revenue(facts),
        "Revenue by Shipper": kpi.revenue_by_shipper(facts, sample.shippers(spark, folder)),
        "Top 10 Products": kpi.top_products(facts, sample.products(spark, folder)),
    }
    return publish.row_counts(charts).withColumnRenamed("table_name", "chart")


# ------------------------------------------------------- documented extensions
@query(
    "product_margin",
    """SELECT product_id, unit_price, cost,
              CAST(CASE WHEN cents <> 0 THEN ((cents - cost_cents) * 20000 + cents) // (2 * cents) END * 0.0001
                   AS DECIMAL(10,4)) AS profit_margin
       FROM (SELECT *, CAST(unit_price * 100 AS BIGINT) AS cents, CAST(cost * 100 AS BIGINT) AS cost_cents
             FROM products)""",
)
def product_margin(spark, folder):
    return gold.product_margin(sample.products(spark, folder))


@query(
    "fact_sales_profit",
    """SELECT f.order_id, f.product_id, f.quantity, f.net_revenue, p.cost AS unit_cost,
              CAST(f.net_revenue - f.quantity * p.cost AS DECIMAL(18,2)) AS gross_profit
       FROM sales f JOIN products p ON f.product_id = p.product_id""",
)
def fact_sales_profit(spark, folder):
    profit = gold.with_profit(_sales(spark, folder), sample.products(spark, folder))
    return profit.select("order_id", "product_id", "quantity", "net_revenue", "unit_cost", "gross_profit")


@query(
    "fact_sales_keyed",
    """SELECT f.order_id, CAST(strftime(f.order_date, '%Y%m%d') AS BIGINT) AS date_key, f.quantity, f.net_revenue,
              p.product_key, c.customer_key
       FROM sales f
       LEFT JOIN (SELECT product_id, row_number() OVER (ORDER BY product_id) AS product_key FROM products) p
              ON f.product_id = p.product_id
       LEFT JOIN (SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key FROM people
                  WHERE city <> 'NATION_7') c ON f.customer_id = c.customer_id""",
)
def fact_sales_keyed(spark, folder):
    """Surrogate keys in the fact; customers of one nation are unknown members."""
    from granary.functions import dates

    facts = _sales(spark, folder).select(
        "order_id", dates.date_key("order_date").alias("date_key"), "quantity", "net_revenue", "product_id", "customer_id"
    )
    known = sample.customers(spark, folder).filter("city <> 'NATION_7'").select("customer_id")
    return gold.with_surrogates(
        facts,
        {
            "product_id": (
                gold.keyed(sample.products(spark, folder).select("product_id"), "product_id", "product_key"),
                "product_id",
                "product_key",
            ),
            "customer_id": (gold.keyed(known, "customer_id", "customer_key"), "customer_id", "customer_key"),
        },
    )


@query(
    "dim_product_latest",
    """SELECT product_id AS product_key, unit_price AS current_price FROM (
           SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY ship_date DESC, order_id DESC,
                     line_number DESC, supplier_id DESC, raw_price DESC) AS rank FROM lines) WHERE rank = 1""",
)
def dim_product_latest(spark, folder):
    recency = ["ship_date", "order_id", "line_number", "supplier_id", "raw_price"]
    return gold.dim_product_latest(sample.lines(spark, folder), recency)


@query(
    "dim_product_documented",
    """SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, sku, product_name,
              CAST(unit_price AS DECIMAL(10,2)) AS current_price, CAST(cost AS DECIMAL(10,2)) AS current_cost,
              CAST(CASE WHEN cents <> 0 THEN ((cents - cost_cents) * 20000 + cents) // (2 * cents) END * 0.0001
                   AS DECIMAL(10,4)) AS profit_margin
       FROM (SELECT p.*, b.p_brand || '-' || p.product_id AS sku, CAST(unit_price * 100 AS BIGINT) AS cents,
                    CAST(cost * 100 AS BIGINT) AS cost_cents
             FROM products p JOIN part b ON p.product_id = b.p_partkey)""",
)
def dim_product_documented(spark, folder):
    return gold.documented_product(_products_with_sku(spark, folder))


def _products_with_sku(spark, folder):
    brands = sample.table(spark, folder, "part").select(F.col("p_partkey").alias("product_id"), "p_brand")
    return sample.products(spark, folder).join(brands, "product_id").withColumn(
        "sku", F.concat_ws("-", "p_brand", F.col("product_id").cast("string"))
    )


@query(
    "fact_sales_documented",
    """SELECT s.line_id AS sale_id, CAST(strftime(s.order_date, '%Y%m%d') AS BIGINT) AS date_key, s.order_id,
              p.product_key, c.customer_key, y.payment_key, s.quantity, s.unit_price, p.cost AS unit_cost,
              CAST(round(s.quantity * s.unit_price, 2) AS DECIMAL(18,2)) AS line_total,
              CAST(round(s.quantity * s.unit_price, 2) - s.net_revenue AS DECIMAL(18,2)) AS discount_amount,
              s.net_revenue, CAST(s.net_revenue - s.quantity * p.cost AS DECIMAL(18,2)) AS gross_profit
       FROM sales s JOIN headers h ON s.order_id = h.order_id
       LEFT JOIN (SELECT product_id, cost, row_number() OVER (ORDER BY product_id) AS product_key FROM products
                  WHERE product_id % 11 <> 0) p ON s.product_id = p.product_id
       LEFT JOIN (SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key FROM people) c
              ON s.customer_id = c.customer_id
       LEFT JOIN (SELECT payment_method, row_number() OVER (ORDER BY payment_method) AS payment_key
                  FROM (SELECT DISTINCT payment_method FROM headers)) y ON h.payment_method = y.payment_method""",
)
def fact_sales_documented(spark, folder):
    """The whole documented row; products of each eleventh key are unknown."""
    headers = sample.order_header(spark, folder)
    known = sample.products(spark, folder).filter("product_id % 11 <> 0")
    return gold.documented_sales(
        sample.lines(spark, folder),
        headers,
        gold.keyed(known, "product_id", "product_key"),
        gold.keyed(sample.customers(spark, folder).select("customer_id"), "customer_id", "customer_key"),
        gold.dim_payment_labelled(headers),
        tuple(sample.LINE_ORDER),
    )


@query(
    "dim_date_th",
    """SELECT DISTINCT CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, order_date AS full_date,
              CAST(year(order_date) AS BIGINT) AS year, CAST(quarter(order_date) AS BIGINT) AS quarter,
              CAST(month(order_date) AS BIGINT) AS month, dayofweek(order_date) IN (0, 6) AS is_weekend,
              list_extract(['มกราคม', 'กุมภาพันธ์', 'มีนาคม', 'เมษายน', 'พฤษภาคม', 'มิถุนายน', 'กรกฎาคม', 'สิงหาคม',
                            'กันยายน', 'ตุลาคม', 'พฤศจิกายน', 'ธันวาคม'], month(order_date)) AS month_name_th,
              list_extract(['อาทิตย์', 'จันทร์', 'อังคาร', 'พุธ', 'พฤหัสบดี', 'ศุกร์', 'เสาร์'],
                           dayofweek(order_date) + 1) AS day_name_th,
              CAST(year(order_date) + 543 + CASE WHEN month(order_date) >= 10 THEN 1 ELSE 0 END AS BIGINT)
                  AS fiscal_year
       FROM heads""",
)
def dim_date_th(spark, folder):
    return gold.dim_date_thai(sample.orders(spark, folder))


# ------------------------------------------------------ counts and reconciling
@query(
    "batch_summary",
    """SELECT 'sample' AS batch, 'customers' AS table_name, count(*) AS rows,
              CAST(NULL AS DECIMAL(18,2)) AS net_revenue FROM people
       UNION ALL SELECT 'sample', 'products', count(*), NULL FROM products
       UNION ALL SELECT 'sample', 'orders', count(*), NULL FROM heads
       UNION ALL SELECT 'sample', 'order_details', count(*), NULL FROM details
       UNION ALL SELECT 'sample', 'shippers', count(*), NULL FROM shippers
       UNION ALL SELECT 'sample', 'fact_sales', count(*), CAST(sum(net_revenue) AS DECIMAL(18,2)) FROM sales""",
)
def batch_summary(spark, folder):
    sources = {
        "customers": sample.customers(spark, folder),
        "products": sample.products(spark, folder),
        "orders": sample.orders(spark, folder),
        "order_details": sample.order_details(spark, folder),
        "shippers": sample.shippers(spark, folder),
    }
    return publish.batch_summary("sample", sources, _sales(spark, folder))


@query(
    "recon_counts",
    """SELECT 'customers' AS table_name, (SELECT count(*) FROM customer) AS source_rows, count(*) AS silver_rows,
              count(*) AS gold_rows, (SELECT count(*) FROM customer) = count(*) AS agrees FROM people
       UNION ALL
       SELECT 'order_details', (SELECT count(*) FROM lineitem), count(*), count(*),
              (SELECT count(*) FROM lineitem) = count(*)
       FROM lines l JOIN heads h ON l.order_id = h.order_id WHERE l.product_id % 7 <> 0""",
)
def recon_counts(spark, folder):
    """Rows per layer; the planted loss of a seventh of the products must show."""
    details = sample.order_details(spark, folder)
    known = sample.products(spark, folder).filter("product_id % 7 <> 0").select("product_id")
    accepted = details.join(known, "product_id", "left_semi")
    layers = {
        "customers": (
            sample.table(spark, folder, "customer"),
            dedup_exact(sample.customers(spark, folder)),
            sample.customers(spark, folder),
        ),
        "order_details": (details, accepted, gold.fact_sales(accepted, sample.orders(spark, folder))),
    }
    parts = []
    for name, frames in layers.items():
        counted = union_all(
            df.agg(F.count("*").alias("rows")).select(F.lit(layer).alias("layer"), "rows")
            for layer, df in zip(("source_rows", "silver_rows", "gold_rows"), frames)
        )
        columns = [
            F.max(F.when(F.col("layer") == layer, F.col("rows"))).alias(layer)
            for layer in ("source_rows", "silver_rows", "gold_rows")
        ]
        parts.append(counted.agg(*columns).withColumn("table_name", F.lit(name)))
    agrees = (F.col("source_rows") == F.col("silver_rows")) & (F.col("silver_rows") == F.col("gold_rows"))
    return union_all(parts).withColumn("agrees", agrees)


@query(
    "recon_revenue",
    """SELECT (SELECT count(*) FROM lineitem) AS source_lines, count(*) AS fact_lines,
              CAST(sum(net_revenue) AS DECIMAL(18,2)) AS expected_revenue,
              CAST(sum(net_revenue) AS DECIMAL(18,2)) AS net_revenue,
              (SELECT count(*) FROM lineitem) = count(*) AS agrees
       FROM sales""",
)
def recon_revenue(spark, folder):
    return northwind.revenue_reconciliation(sample.order_details(spark, folder), _sales(spark, folder))


@query(
    "dq_revenue_difference",
    """SELECT order_id, total_amount AS net_revenue,
              CAST(CAST(round(quantity * unit_price, 2) AS DECIMAL(18,2))
                   - CAST(quantity * unit_price * discount_pct * 0.01 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS computed
       FROM silver
       WHERE total_amount <> CAST(round(quantity * unit_price, 2) AS DECIMAL(18,2))
                             - CAST(quantity * unit_price * discount_pct * 0.01 AS DECIMAL(18,2))""",
)
def dq_revenue_difference(spark, folder):
    """Orders whose stated total differs from line total minus discount."""
    from granary.catalog.silver import silver_orders_frame

    facts = gold.fact_sales_local(silver_orders_frame(spark, folder))
    computed = numbers.money(F.col("line_total") - F.col("discount_amount"))
    return facts.select("order_id", "net_revenue", computed.alias("computed")).filter("net_revenue <> computed")
