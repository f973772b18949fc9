"""Pricing, loyalty, stock, shipments, payloads and generated orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.catalog.model_sql import padded
from granary.catalog.registry import query
from granary.contracts import CARRIERS, SHIPPING_COSTS, coupon_table
from granary.functions import payload
from granary.operators import quality
from granary.plans import generate, inventory, logistics, marketing, pricing, silver
from granary.session import scratch_path
from granary.sources import sample


def _baskets(spark, folder):
    return pricing.baskets(sample.order_items(spark, folder), sample.order_header(spark, folder))


def _priced(spark, folder):
    return pricing.priced(_baskets(spark, folder), coupon_table(spark))


def _accounts(spark, folder):
    """Points per customer, whose key stands in for the phone number."""
    return _priced(spark, folder).groupBy(F.col("customer_id").alias("phone")).agg(
        F.sum("points").cast("bigint").alias("points")
    )


def _levels(spark, folder):
    return inventory.stock_levels(sample.stock_log(spark, folder)).withColumn("reorder_point", sample.reorder_point())


# -------------------------------------------------------------------- pricing
@query("order_subtotals", "SELECT * FROM subtotals")
def order_subtotals(spark, folder):
    return pricing.order_subtotals(sample.order_items(spark, folder))


@query(
    "coupon_validity_join",
    """SELECT h.order_id, c.code FROM headers h JOIN coupons c ON h.wanted = c.code
       WHERE h.order_date BETWEEN c.start_date AND c.end_date""",
)
def coupon_validity_join(spark, folder):
    return pricing.valid_coupons(sample.order_header(spark, folder), coupon_table(spark)).select("order_id", "code")


@query("eligible_coupons", "SELECT order_id, subtotal, code, CAST(exact AS DECIMAL(18,2)) AS discount FROM eligible")
def eligible_coupons(spark, folder):
    found = pricing.eligible_coupons(_baskets(spark, folder), coupon_table(spark))
    return found.select("order_id", "subtotal", "code", "discount")


@query(
    "priced_orders",
    "SELECT order_id, customer_id, order_date, subtotal, coupon, discount, final_price, total_with_shipping FROM priced",
)
def priced_orders(spark, folder):
    return _priced(spark, folder).select(
        "order_id", "customer_id", "order_date", "subtotal", "coupon", "discount", "final_price", "total_with_shipping"
    )


@query(
    "priced_orders_auto",
    "SELECT order_id, customer_id, order_date, subtotal, coupon, discount, final_price, total_with_shipping "
    "FROM priced_auto",
)
def priced_orders_auto(spark, folder):
    """Baskets that name no coupon get the best one in force."""
    return pricing.priced(_baskets(spark, folder), coupon_table(spark), auto_apply=True).select(
        "order_id", "customer_id", "order_date", "subtotal", "coupon", "discount", "final_price", "total_with_shipping"
    )


@query(
    "priced_orders_windows",
    """WITH offers AS (
           SELECT 'S' || s_suppkey AS code, s_suppkey % 3 <> 0 AS pct, CAST(1 + s_suppkey % 30 AS DECIMAL(10,2)) AS value,
                  CAST(s_suppkey % 7 * 1000 AS DECIMAL(10,2)) AS low,
                  TIMESTAMP '1995-01-01 00:30:00' + to_minutes(s_suppkey * 2225) AS begins,
                  TIMESTAMP '1995-01-01 00:30:00' + to_minutes(s_suppkey * 2225 + s_suppkey % 90 * 1440 + 17) AS ends
           FROM supplier
       ), timed AS (
           SELECT order_id, subtotal, CAST(order_date AS TIMESTAMP) + to_minutes(order_id * 7 % 1440) AS moment FROM baskets
       ), tried AS (
           SELECT order_id, code, least(CASE WHEN pct THEN CAST(subtotal * value * 0.01 AS DECIMAL(24,6)) * 1
                  ELSE CAST(value * 40 AS DECIMAL(24,6)) END, CAST(subtotal AS DECIMAL(24,6))) AS exact
           FROM timed JOIN offers ON moment BETWEEN begins AND ends AND subtotal >= low
       ), best AS (
           SELECT * FROM tried QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY exact DESC, code) = 1
       )
       SELECT order_id, code AS coupon, CAST(coalesce(exact, 0) AS DECIMAL(18,2)) AS discount
       FROM timed LEFT JOIN best USING (order_id)""",
)
def priced_orders_windows(spark, folder):
    """Baskets at a minute of their day, each with the best of many coupons whose windows begin and end at minutes."""
    begins = F.lit("1995-01-01 00:30:00").cast("timestamp")
    key, minutes = F.col("s_suppkey"), F.col("s_suppkey") * 2225
    offers = sample.table(spark, folder, "supplier").select(
        F.concat(F.lit("S"), key.cast("string")).alias("code"),
        F.when(key % 3 != 0, "percentage").otherwise("fixed").alias("discount_type"),
        ((1 + key % 30) * F.when(key % 3 != 0, 1).otherwise(40)).cast("decimal(10,2)").alias("value"),
        (key % 7 * 1000).cast("decimal(10,2)").alias("min_purchase"),
        F.lit(True).alias("active"),
        F.timestamp_seconds(F.unix_timestamp(begins) + minutes * 60).alias("start_date"),
        F.timestamp_seconds(F.unix_timestamp(begins) + (minutes + key % 90 * 1440 + 17) * 60).alias("end_date"),
    )
    minute = F.col("order_id") * 7 % 1440 * 60
    timed = _baskets(spark, folder).select(
        "order_id", "subtotal", F.timestamp_seconds(F.unix_timestamp(F.col("order_date").cast("timestamp")) + minute).alias("at"),
        F.lit(None).cast("string").alias("coupon_code"),
    )
    return pricing.priced(timed, offers, at="at", auto_apply=True).select("order_id", "coupon", "discount")


@query("applied_coupon", "SELECT order_id, coupon, discount FROM priced WHERE coupon IS NOT NULL")
def applied_coupon(spark, folder):
    return _priced(spark, folder).filter("coupon is not null").select("order_id", "coupon", "discount")


@query("loyalty_points", "SELECT order_id, customer_id, points FROM priced WHERE points > 0")
def loyalty_points(spark, folder):
    return pricing.points_earned(_priced(spark, folder))


# ------------------------------------------------------------------ marketing
@query(
    "loyalty_balances",
    """SELECT phone, CAST(sum(points) AS BIGINT) AS points FROM (
           SELECT customer_id AS phone, points FROM priced WHERE points > 0
           UNION ALL SELECT c_custkey, CAST(floor(c_acctbal / 100) AS BIGINT) FROM customer WHERE c_acctbal >= 100)
       GROUP BY phone""",
)
def loyalty_balances(spark, folder):
    """Opening balances from the account, then the points of all orders."""
    opening = sample.table(spark, folder, "customer").filter("c_acctbal >= 100").select(
        F.col("c_custkey").alias("phone"), F.floor(F.col("c_acctbal") / 100).cast("bigint").alias("points")
    )
    earned = pricing.points_earned(_priced(spark, folder)).withColumnRenamed("customer_id", "phone")
    return marketing.loyalty_balances(opening, earned)


@query(
    "loyalty_tiers",
    """SELECT phone, points, CASE WHEN points >= 1000 THEN 'Platinum' WHEN points >= 500 THEN 'Gold'
              ELSE 'Silver' END AS tier
       FROM (SELECT customer_id AS phone, CAST(sum(points) AS BIGINT) AS points FROM priced GROUP BY customer_id)""",
)
def loyalty_tiers(spark, folder):
    return marketing.with_tier(_accounts(spark, folder))


@query(
    "silver_loyalty",
    """SELECT phone AS loyalty_id, points, CASE WHEN points >= 1000 THEN 'Platinum' WHEN points >= 500 THEN 'Gold'
              ELSE 'Silver' END AS tier
       FROM (SELECT customer_id AS phone, CAST(sum(points) AS BIGINT) AS points FROM priced GROUP BY customer_id)""",
)
def silver_loyalty(spark, folder):
    return silver.loyalty_accounts(_accounts(spark, folder).withColumnRenamed("phone", "loyalty_id"))


@query(
    "loyalty_ranking",
    """SELECT phone, points, row_number() OVER (ORDER BY points DESC, phone) AS position
       FROM (SELECT customer_id AS phone, CAST(sum(points) AS BIGINT) AS points FROM priced GROUP BY customer_id)""",
)
def loyalty_ranking(spark, folder):
    return marketing.loyalty_ranking(_accounts(spark, folder))


@query(
    "marketing_stats",
    """SELECT (SELECT count(*) FROM coupons WHERE DATE '1997-06-01' BETWEEN start_date AND end_date) AS active_coupons,
              count(DISTINCT customer_id) AS total_members, CAST(sum(points) AS BIGINT) AS total_points
       FROM priced""",
)
def marketing_stats(spark, folder):
    at = F.lit("1997-06-01").cast("date")
    return marketing.marketing_stats(coupon_table(spark), _accounts(spark, folder), at)


@query(
    "fact_marketing",
    """SELECT c.code, CAST(strftime(c.start_date, '%Y%m%d') AS BIGINT) AS start_date_key,
              CAST(strftime(c.end_date, '%Y%m%d') AS BIGINT) AS end_date_key, c.discount_type,
              c.value AS discount_value, count(p.order_id) AS times_used
       FROM coupons c LEFT JOIN priced p ON p.coupon = c.code GROUP BY ALL""",
)
def fact_marketing(spark, folder):
    return marketing.fact_marketing(coupon_table(spark), _priced(spark, folder))


@query(
    "coupon_windows",
    """SELECT order_id,
              CASE WHEN order_id % 3 = 0 THEN TIMESTAMP '2026-01-01 00:00:00'
                   WHEN order_id % 7 = 0 THEN NULL
                   ELSE CAST(order_date AS TIMESTAMP) + INTERVAL 150 MINUTE END AS start_date,
              CASE WHEN order_id % 4 = 0 THEN TIMESTAMP '2026-01-31 00:00:00'
                   ELSE CAST(order_date AS TIMESTAMP) + INTERVAL 33 DAY - INTERVAL 7 HOUR END AS end_date
       FROM headers""",
)
def coupon_windows(spark, folder):
    """Form texts built from order dates: blank, malformed and good ones."""
    day = F.col("order_date")
    start = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T09:30"))
    end = F.concat(F.lit(" "), F.date_format(F.date_add(day, 33), "yyyy-MM-dd"), F.lit("T00:00"))
    forms = sample.order_header(spark, folder).select(
        "order_id",
        F.when(F.col("order_id") % 3 == 0, " ").when(F.col("order_id") % 7 == 0, "soon").otherwise(start).alias("start_text"),
        F.when(F.col("order_id") % 4 == 0, F.lit(None)).otherwise(end).alias("end_text"),
    )
    windows = marketing.coupon_windows(forms, F.lit("2026-01-01 00:00:00").cast("timestamp"))
    return windows.select(
        "order_id", F.col("start_date").cast("timestamp_ntz"), F.col("end_date").cast("timestamp_ntz")
    )


@query(
    "dim_customer_tiered",
    """SELECT p.customer_id AS customer_key, p.company_name AS customer_name,
              CASE WHEN coalesce(sum(o.points), 0) >= 1000 THEN 'Platinum'
                   WHEN coalesce(sum(o.points), 0) >= 500 THEN 'Gold' ELSE 'Silver' END AS loyalty_tier,
              count(o.order_id) AS total_orders,
              CAST(coalesce(sum(o.final_price), 0) AS DECIMAL(18,2)) AS total_spent
       FROM people p LEFT JOIN priced o ON p.customer_id = o.customer_id GROUP BY p.customer_id, p.company_name""",
)
def dim_customer_tiered(spark, folder):
    return marketing.dim_customer_tiered(sample.customers(spark, folder), _priced(spark, folder))


# ------------------------------------------------------------------ inventory
@query(
    "stock_running_balance",
    """SELECT log_id, product_id, change_quantity, CAST(sum(change_quantity) OVER (PARTITION BY product_id
              ORDER BY created_at, log_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance
       FROM log""",
)
def stock_running_balance(spark, folder):
    ledger = inventory.running_balance(
        sample.stock_log(spark, folder).select("log_id", "product_id", "created_at", "change_quantity")
    )
    return ledger.select("log_id", "product_id", "change_quantity", F.col("balance").cast("bigint").alias("balance"))


@query(
    "fact_stock_snapshot",
    """SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS snapshot_date_key, g.product_id AS product_key,
              CAST(sum(coalesce(d.change, 0)) OVER (PARTITION BY g.product_id ORDER BY day) AS BIGINT)
                  AS current_quantity,
              sum(coalesce(d.change, 0)) OVER (PARTITION BY g.product_id ORDER BY day) <= g.product_id % 20
                  AS is_low_stock
       FROM (SELECT product_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
             FROM daily_log GROUP BY product_id) g
       LEFT JOIN daily_log d USING (product_id, day)""",
)
def fact_stock_snapshot(spark, folder):
    reorder = sample.table(spark, folder, "events").select(F.col("user_id").alias("product_id")).distinct()
    return inventory.stock_snapshot(
        sample.stock_log(spark, folder), reorder.withColumn("reorder_point", sample.reorder_point())
    )


@query(
    "days_of_supply",
    """SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS snapshot_date_key, product_id AS product_key,
              quantity AS current_quantity,
              CAST(CASE WHEN used > 0 THEN sign(quantity) * ((abs(quantity) * 600000 + used) // (2 * used)) END * 0.0001
                   AS DECIMAL(18,4)) AS days_of_supply
       FROM (SELECT product_id, day,
                    CAST(sum(change) OVER (PARTITION BY product_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT)
                        AS quantity,
                    CAST(sum(outbound) OVER (PARTITION BY product_id ORDER BY day
                         RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS used
             FROM daily_log)""",
)
def days_of_supply(spark, folder):
    return inventory.days_of_supply(sample.stock_log(spark, folder))


@query(
    "fact_stock_snapshot_documented",
    """SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS snapshot_date_key, product_id AS product_key,
              quantity AS current_quantity,
              coalesce(product_id % 9 <> 0 AND quantity <= product_id % 20, false) AS is_low_stock,
              CAST(CASE WHEN used > 0 THEN sign(quantity) * ((abs(quantity) * 600000 + used) // (2 * used)) END * 0.0001
                   AS DECIMAL(18,4)) AS days_of_supply
       FROM (SELECT product_id, day,
                    CAST(sum(change) OVER (PARTITION BY product_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT)
                        AS quantity,
                    CAST(sum(outbound) OVER (PARTITION BY product_id ORDER BY day
                         RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS used
             FROM (SELECT g.product_id, g.day, coalesce(d.change, 0) AS change, coalesce(d.outbound, 0) AS outbound
                   FROM (SELECT product_id,
                                CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
                         FROM daily_log GROUP BY product_id) g
                   LEFT JOIN daily_log d USING (product_id, day)))""",
)
def fact_stock_snapshot_documented(spark, folder):
    """Days of supply on every day; products of each ninth key have no reorder point."""
    points = sample.table(spark, folder, "events").select(F.col("user_id").alias("product_id")).distinct()
    points = points.filter("product_id % 9 <> 0").withColumn("reorder_point", sample.reorder_point())
    return inventory.documented_snapshot(sample.stock_log(spark, folder), points)


@query(
    "low_stock",
    """SELECT product_id, quantity, reorder_point, quantity - reorder_point AS margin FROM levels
       WHERE quantity <= reorder_point""",
)
def low_stock(spark, folder):
    return inventory.low_stock(_levels(spark, folder))


@query(
    "inventory_stats",
    """SELECT CAST(sum(quantity) AS BIGINT) AS total_items,
              CAST(count(*) FILTER (WHERE quantity <= reorder_point) AS BIGINT) AS low_stock_count,
              count(*) AS sku_count
       FROM levels""",
)
def inventory_stats(spark, folder):
    return inventory.inventory_stats(_levels(spark, folder))


@query(
    "stock_log_recent",
    """SELECT l.log_id, l.created_at, p.product_name, l.log_type,
              CASE WHEN l.change_quantity > 0 THEN '+' ELSE '' END || l.change_quantity AS change,
              coalesce(nullif(l.reason, ''), '-') AS reason
       FROM (SELECT * FROM log ORDER BY created_at DESC, log_id DESC LIMIT 10) l
       JOIN products p ON l.product_id = p.product_id""",
)
def stock_log_recent(spark, folder):
    return inventory.recent_log(sample.stock_log(spark, folder), sample.products(spark, folder))


@query(
    "available_stock",
    """SELECT p.product_id, coalesce(l.quantity, 0) AS available
       FROM products p LEFT JOIN levels l ON p.product_id = l.product_id""",
)
def available_stock(spark, folder):
    return inventory.available(sample.products(spark, folder), _levels(spark, folder))


@query(
    "fact_inventory",
    """SELECT log_id, CAST(strftime(created_at, '%Y%m%d') AS BIGINT) AS date_key, product_id AS product_key, log_type,
              change_quantity FROM log""",
)
def fact_inventory(spark, folder):
    return inventory.fact_inventory(sample.stock_log(spark, folder))


@query(
    "outbound_from_sales",
    """SELECT order_id, product_id, -quantity AS change_quantity, 'outbound' AS log_type,
              'ขายผ่านคำสั่งซื้อ #' || order_id AS reason FROM items""",
)
def outbound_from_sales(spark, folder):
    return inventory.outbound_from_sales(sample.order_items(spark, folder))


@query(
    "oversell_report",
    """SELECT product_id, stock, order_id, demand FROM (
           SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY order_date, order_id, line_number,
                     supplier_id, ship_date, raw_price) AS rank
           FROM (SELECT i.*, h.order_date, 10 + i.product_id % 50 AS stock,
                        CAST(sum(i.quantity) OVER (PARTITION BY i.product_id ORDER BY h.order_date, i.order_id,
                             i.line_number, i.supplier_id, i.ship_date, i.raw_price ROWS UNBOUNDED PRECEDING)
                             AS BIGINT) AS demand
                 FROM items i JOIN heads h ON i.order_id = h.order_id) WHERE demand > stock)
       WHERE rank = 1""",
)
def oversell_report(spark, folder):
    days = sample.orders(spark, folder).select("order_id", "order_date")
    demand = sample.order_items(spark, folder).drop("price").join(days, "order_id")
    stock = sample.products(spark, folder).select("product_id", (10 + F.col("product_id") % 50).alias("stock"))
    return inventory.oversell_report(demand, stock, ["order_id", "line_number", "supplier_id", "ship_date", "raw_price"])


# ------------------------------------------------------------------ logistics
@query(
    "shipment_board",
    """SELECT s.order_id, h.customer_id, h.order_status, s.tracking_number, s.carrier, s.shipping_cost, s.status,
              s.updated_at, CAST(CASE s.status WHEN 'shipping' THEN 40 WHEN 'delivered' THEN 80 ELSE 0 END AS BIGINT)
              AS progress
       FROM parcels s JOIN headers h ON s.order_id = h.order_id""",
)
def shipment_board(spark, folder):
    return logistics.board(sample.shipments(spark, folder), sample.order_header(spark, folder))


@query(
    "shipment_progress",
    """SELECT shipment_id, status, CAST(CASE status WHEN 'preparing' THEN 0 WHEN 'shipping' THEN 40
              WHEN 'delivered' THEN 80 ELSE 0 END AS BIGINT) AS progress
       FROM parcels""",
)
def shipment_progress(spark, folder):
    return sample.shipments(spark, folder).select("shipment_id", "status", logistics.progress().alias("progress"))


@query(
    "shipment_status_counts",
    """SELECT count(*) AS total_shipments,
              CAST(count(*) FILTER (WHERE status = 'preparing') AS BIGINT) AS preparing_count,
              CAST(count(*) FILTER (WHERE status = 'shipping') AS BIGINT) AS shipping_count,
              CAST(count(*) FILTER (WHERE status = 'delivered') AS BIGINT) AS delivered_count
       FROM parcels""",
)
def shipment_status_counts(spark, folder):
    return logistics.status_counts(sample.shipments(spark, folder))


@query(
    "order_detail",
    """SELECT s.tracking_number, i.order_id, s.status, p.product_name, i.price, i.quantity,
              CAST(i.price * i.quantity AS DECIMAL(18,2)) AS subtotal
       FROM parcels s JOIN items i ON s.order_id = i.order_id JOIN products p ON i.product_id = p.product_id""",
)
def order_detail(spark, folder):
    return logistics.order_detail(
        sample.shipments(spark, folder), sample.order_items(spark, folder), sample.products(spark, folder)
    )


@query(
    "tracking_lookup",
    """SELECT CASE WHEN order_id % 2 = 0 THEN ' ' || lower(tracking_number) ELSE tracking_number || chr(9) END AS query,
              tracking_number, order_id, status, carrier FROM parcels WHERE order_id % 9 <> 0""",
)
def tracking_lookup(spark, folder):
    """Every order's number typed in with other case or padding; some unknown."""
    known = sample.shipments(spark, folder)
    number = F.when(F.col("order_id") % 9 == 0, F.concat("tracking_number", F.lit("X"))).otherwise(F.col("tracking_number"))
    typed_in = F.when(F.col("order_id") % 2 == 0, F.concat(F.lit(" "), F.lower(number))).otherwise(
        F.concat(number, F.lit("\t"))
    )
    return logistics.tracking_lookup(known.select(typed_in.alias("query")), known)


@query(
    "tracking_lookup_indexed",
    """SELECT lower(tracking_number) || ' ' AS query, tracking_number, order_id, status, carrier FROM parcels
       WHERE updated_at > (SELECT max(updated_at) - INTERVAL 30 DAY FROM parcels)""",
)
def tracking_lookup_indexed(spark, folder):
    """Numbers of the newest 30 days looked up in the published shipments; only files that may hold them are opened."""
    root, parcels = scratch_path(spark, "tracking"), sample.shipments(spark, folder)
    parcels.repartitionByRange("updated_at").write.parquet(f"{root}/shipments")
    logistics.index_tracking(spark, f"{root}/shipments", f"{root}/index")
    newest = parcels.agg(F.max("updated_at").alias("at")).first().at
    asked = parcels.where(F.col("updated_at") > F.date_sub(F.lit(newest), 30))
    asked = asked.select(F.concat(F.lower("tracking_number"), F.lit(" ")).alias("query"))
    unknown = asked.select(F.concat(F.lit("x"), "query").alias("query"))
    return logistics.indexed_lookup(spark, asked.union(unknown), f"{root}/shipments", f"{root}/index")


@query(
    "order_status_sync",
    """SELECT h.order_id, h.order_status AS old_status,
              CASE WHEN s.status = 'delivered' THEN 'shipped' ELSE h.order_status END AS new_status
       FROM headers h JOIN parcels s ON h.order_id = s.order_id""",
)
def order_status_sync(spark, folder):
    return logistics.sync_order_status(sample.order_header(spark, folder), sample.shipments(spark, folder))


@query(
    "shipments_from_orders",
    """SELECT order_id, order_status, CASE order_status WHEN 'paid' THEN 'delivered' ELSE 'shipping' END AS status
       FROM headers WHERE order_status IN ('paid', 'shipped')""",
)
def shipments_from_orders(spark, folder):
    found = logistics.shipments_from_orders(sample.order_header(spark, folder))
    return found.select("order_id", "order_status", "status")


@query(
    "dim_carrier",
    """SELECT row_number() OVER (ORDER BY carrier) AS carrier_key, carrier AS carrier_name
       FROM (SELECT DISTINCT carrier FROM parcels)""",
)
def dim_carrier(spark, folder):
    return logistics.dim_carrier(sample.shipments(spark, folder))


@query(
    "fact_logistics",
    """SELECT shipment_id, CAST(strftime(updated_at, '%Y%m%d') AS BIGINT) AS date_key, carrier_key,
              status AS shipment_status, shipping_cost
       FROM parcels JOIN (SELECT carrier, row_number() OVER (ORDER BY carrier) AS carrier_key
                          FROM (SELECT DISTINCT carrier FROM parcels)) USING (carrier)""",
)
def fact_logistics(spark, folder):
    shipments = sample.shipments(spark, folder)
    return logistics.fact_logistics(shipments, logistics.dim_carrier(shipments))


# -------------------------------------------------------------------- ratings
@query(
    "payload_parse",
    """SELECT event_id, id, rating_text IS NOT NULL AS has_rating, try_cast(rating_text AS DOUBLE) AS rating
       FROM bodies""",
)
def payload_parse(spark, folder):
    text = sample.payloads(spark, folder).withColumn("text", payload.rating_text("body"))
    return text.select(
        "event_id", "id", F.col("text").isNotNull().alias("has_rating"), payload.rating_value("text").alias("rating")
    )


@query(
    "payload_validate",
    """SELECT event_id, CASE WHEN rating_text IS NULL THEN 'rating is required'
              WHEN try_cast(rating_text AS DOUBLE) IS NULL THEN 'rating must be a number' END AS error,
              try_cast(rating_text AS DOUBLE) AS rating
       FROM bodies""",
)
def payload_validate(spark, folder):
    text = sample.payloads(spark, folder).withColumn("text", payload.rating_text("body"))
    return text.select("event_id", payload.rating_error("text").alias("error"), payload.rating_value("text").alias("rating"))


@query(
    "top_rated",
    """SELECT user_id AS id, value AS rating FROM events ORDER BY value DESC, user_id LIMIT 1""",
)
def top_rated(spark, folder):
    best = F.max_by(F.struct("id", "rating"), F.struct(F.col("rating"), -F.col("id"))).alias("best")
    return sample.ratings(spark, folder).agg(best).select("best.id", "best.rating")


# ------------------------------------------------------------ generated orders
GENERATOR_SEED = 20260922


def _list_sql(values: list) -> str:
    """A DuckDB list of the generator's fixed values."""
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _draw_sql(field: str, key: str, n: str) -> str:
    return f"('0x' || substr(md5('{GENERATOR_SEED}:{field}:' || {key}), 1, 12))::BIGINT % {n}"


@query(
    "gen_order_lines",
    f"""SELECT 'ORD' || {padded("id", 8)} AS order_id, order_date,
               'CUS' || {padded("id", 8)} AS customer_id, 'ลูกค้า ' || id AS customer_name,
               'customer' || id || '@example.com' AS customer_email,
               '08' || {padded("phone", 8)} AS customer_phone, product_id, product_name, category,
               quantity, unit_price, discount_pct, payment_method, shipping_status, province,
               CAST(quantity * unit_price * (100 - discount_pct) * 0.01 AS DECIMAL(18,2)) AS total_amount
        FROM (SELECT o_orderkey AS id,
                     CAST(DATE '2026-09-22' - CAST({_draw_sql("day", "o_orderkey", "366")} AS INTEGER) AS DATE)
                         AS order_date,
                     {_draw_sql("product", "o_orderkey", "(SELECT count(*) FROM part)")} AS n,
                     {_draw_sql("quantity", "o_orderkey", "5")} + 1 AS quantity,
                     CAST(list_extract({_list_sql(generate.DISCOUNT_CHOICES)}, {_draw_sql("discount", "o_orderkey", "6")} + 1) AS BIGINT)
                         AS discount_pct,
                     list_extract({_list_sql(generate.GENERATED_PAYMENTS)},
                                  {_draw_sql("payment", "o_orderkey", "4")} + 1) AS payment_method,
                     list_extract({_list_sql(generate.GENERATED_SHIPPING)},
                                  {_draw_sql("shipping", "o_orderkey", "4")} + 1) AS shipping_status,
                     {_draw_sql("province", "o_orderkey", "(SELECT count(*) FROM nation)")} AS place,
                     {_draw_sql("phone", "o_orderkey", "100000000")} AS phone
              FROM orders)
        JOIN (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
                     CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
                     row_number() OVER (ORDER BY p_partkey) - 1 AS n FROM part) USING (n)
        JOIN (SELECT n_name AS province, row_number() OVER (ORDER BY n_name) - 1 AS place FROM nation) USING (place)""",
)
def gen_order_lines(spark, folder):
    """One generated line per order of the table, from its product catalogue."""
    ids = sample.order_ids(spark, folder)
    products = sample.table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"),
    )
    return generate.order_lines(ids, products, GENERATOR_SEED, "2026-09-22", sample.provinces(spark, folder))


@query(
    "gen_orders",
    f"""WITH drawn AS (
            SELECT o_orderkey AS order_id, {_draw_sql("items", "o_orderkey", "100")} AS i,
                   {_draw_sql("first", "o_orderkey", "(SELECT count(*) FROM part)")} AS first,
                   {_draw_sql("stride", "o_orderkey", "(SELECT greatest(1, count(*) // 5) FROM part)")} + 1 AS stride,
                   {_draw_sql("order_discount", "o_orderkey", "100")} AS d,
                   {_draw_sql("status", "o_orderkey", "100")} AS s, {_draw_sql("payment", "o_orderkey", "100")} AS p
            FROM orders),
        slots AS (
            SELECT order_id, slot, (first + slot * stride) % (SELECT count(*) FROM part) AS n,
                   {_draw_sql("quantity", "order_id || ':' || slot", "100")} AS q
            FROM (SELECT *, unnest(range(CASE WHEN i < 20 THEN 1 WHEN i < 55 THEN 2 WHEN i < 80 THEN 3 WHEN i < 95 THEN 4
                         ELSE 5 END)) AS slot FROM drawn)),
        totals AS (
            SELECT order_id, count(*) AS items,
                   CAST(sum(price * CASE WHEN q < 60 THEN 1 WHEN q < 90 THEN 2 ELSE 3 END) AS DECIMAL(18,2)) AS total_price
            FROM slots JOIN (SELECT CAST(p_retailprice AS DECIMAL(18,2)) AS price,
                                    row_number() OVER (ORDER BY p_partkey) - 1 AS n FROM part) USING (n)
            GROUP BY order_id),
        cents AS (
            SELECT t.*, d.s, d.p, CAST(total_price * 100 AS BIGINT) * CASE WHEN total_price < 1000 OR d.d < 40 THEN 0
                   WHEN d.d < 70 THEN 5 WHEN d.d < 90 THEN 10 ELSE 15 END AS c
            FROM totals t JOIN drawn d USING (order_id)),
        rounded AS (
            SELECT *, CAST((c // 100 + CASE WHEN c % 100 > 50 OR (c % 100 = 50 AND (c // 100) % 2 = 1) THEN 1 ELSE 0 END)
                      * 0.01 AS DECIMAL(18,2)) AS discount_applied FROM cents)
        SELECT order_id, items, total_price, discount_applied,
               CAST(total_price - discount_applied AS DECIMAL(18,2)) AS final_price,
               CASE WHEN s < 80 THEN 'paid' WHEN s < 88 THEN 'shipped' WHEN s < 95 THEN 'pending' ELSE 'cancelled' END
                   AS status,
               CASE WHEN p < 50 THEN 'promptpay' WHEN p < 80 THEN 'credit' ELSE 'cod' END AS payment_method
        FROM rounded""",
)
def gen_orders(spark, folder):
    ids = sample.order_ids(spark, folder)
    return generate.orders(ids, sample.products(spark, folder), GENERATOR_SEED)


@query(
    "gen_order_items",
    f"""WITH drawn AS (
            SELECT o_orderkey AS order_id, {_draw_sql("items", "o_orderkey", "100")} AS i,
                   {_draw_sql("first", "o_orderkey", "(SELECT count(*) FROM part)")} AS first,
                   {_draw_sql("stride", "o_orderkey", "(SELECT greatest(1, count(*) // 5) FROM part)")} + 1 AS stride
            FROM orders),
        slots AS (
            SELECT order_id, (first + slot * stride) % (SELECT count(*) FROM part) AS n,
                   {_draw_sql("quantity", "order_id || ':' || slot", "100")} AS q
            FROM (SELECT *, unnest(range(CASE WHEN i < 20 THEN 1 WHEN i < 55 THEN 2 WHEN i < 80 THEN 3 WHEN i < 95 THEN 4
                         ELSE 5 END)) AS slot FROM drawn))
        SELECT order_id, product_id, price,
               CAST(CASE WHEN q < 60 THEN 1 WHEN q < 90 THEN 2 ELSE 3 END AS BIGINT) AS quantity
        FROM slots JOIN (SELECT p_partkey AS product_id, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
                                row_number() OVER (ORDER BY p_partkey) - 1 AS n FROM part) USING (n)""",
)
def gen_order_items(spark, folder):
    return generate.order_items(sample.order_ids(spark, folder), sample.products(spark, folder), GENERATOR_SEED)


@query(
    "gen_shipments",
    f"""SELECT order_id,
               'TH' || upper(substr(md5('{GENERATOR_SEED}:tracking:' || order_id), 1, 14)) AS tracking_number,
               list_extract({_list_sql(CARRIERS)}, {_draw_sql("carrier", "order_id", "6")} + 1) AS carrier,
               CAST(list_extract({_list_sql(SHIPPING_COSTS)}, {_draw_sql("cost", "order_id", "6")} + 1)
                    AS DECIMAL(10,2)) AS shipping_cost,
               CASE WHEN s < 80 THEN 'delivered' ELSE 'shipping' END AS status
        FROM (SELECT o_orderkey AS order_id, {_draw_sql("status", "o_orderkey", "100")} AS s FROM orders)
        WHERE s < 88""",
)
def gen_shipments(spark, folder):
    return generate.shipments(gen_orders(spark, folder), GENERATOR_SEED)


@query(
    "stock_coverage",
    """SELECT product_id, 'missing' AS state FROM products WHERE product_id NOT IN (SELECT product_id FROM levels)
       UNION ALL
       SELECT product_id, 'unexpected' FROM levels WHERE product_id NOT IN (SELECT product_id FROM products)""",
)
def stock_coverage(spark, folder):
    """Products without a stock row, and stock rows of unknown products."""
    return quality.set_difference(
        sample.products(spark, folder).select("product_id"), _levels(spark, folder).select("product_id")
    )
