"""The retail model over the sample tables in plain SQL, for the check side.

Written apart from the Spark adapter so that the two can disagree.
"""

from __future__ import annotations

import re

from granary.contracts import CARRIERS, SHIPPING_COSTS

LINE_ORDER = "order_id, line_number, product_id, supplier_id, ship_date, raw_price"



def _cases(values) -> str:
    """WHEN branches 0, 1, 2 ... of the given SQL values."""
    return " ".join(f"WHEN {n} THEN {value}" for n, value in enumerate(values))


def padded(number: str, width: int) -> str:
    """SQL of a number with leading zeros up to ``width``; a longer one stays whole."""
    digits = f"CAST({number} AS VARCHAR)"
    return f"CASE WHEN length({digits}) < {width} THEN lpad({digits}, {width}, '0') ELSE {digits} END"


def _priced(applied: str) -> str:
    """SQL of the priced baskets, given the table of the coupons they get."""
    return f"""
        SELECT b.order_id, b.customer_id, b.order_date, b.order_status, b.payment_method, b.subtotal,
               a.code AS coupon,
               CAST(coalesce(a.exact, 0) AS DECIMAL(18,2)) AS discount,
               CAST(CAST(b.subtotal AS DECIMAL(24,6)) - coalesce(a.exact, 0) AS DECIMAL(18,2)) AS final_price,
               CAST(CAST(b.subtotal AS DECIMAL(24,6)) - coalesce(a.exact, 0) + 50 AS DECIMAL(18,2))
                   AS total_with_shipping,
               CAST(floor((CAST(b.subtotal AS DECIMAL(24,6)) - coalesce(a.exact, 0)) * 0.01) AS BIGINT) AS points
        FROM baskets b LEFT JOIN {applied} a ON b.order_id = a.order_id"""


MODEL = {
    "lines": """
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_number, l_partkey AS product_id,
               l_suppkey AS supplier_id, l_shipdate AS ship_date, l_extendedprice AS raw_price,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(l_discount AS DECIMAL(6,4)) AS discount
        FROM lineitem""",
    "details": f"""
        SELECT row_number() OVER (ORDER BY {LINE_ORDER}) AS line_id,
               order_id, product_id, unit_price, quantity, discount
        FROM lines""",
    "heads": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               o_orderkey % 10 AS shipper_id, CAST(o_totalprice AS DECIMAL(18,2)) AS freight
        FROM orders""",
    "people": """
        SELECT c_custkey AS customer_id, c_name AS company_name, n_name AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_size AS BIGINT) AS category_id,
               CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.7 AS DECIMAL(18,2)) AS cost
        FROM part""",
    "shippers": "SELECT s_suppkey AS shipper_id, s_name AS shipper_name FROM supplier",
    "sales": """
        SELECT *, CAST(quantity * unit_price * (1 - discount) AS DECIMAL(18,2)) AS net_revenue
        FROM details JOIN (SELECT order_id, customer_id, order_date, shipper_id FROM heads) USING (order_id)""",
    "dashboard": """
        SELECT * FROM sales
        JOIN (SELECT product_id, product_name, category_id FROM products) USING (product_id)
        JOIN (SELECT customer_id, city FROM people) USING (customer_id)
        JOIN shippers USING (shipper_id)""",
    "raw": f"""
        SELECT CASE WHEN l.product_id % 11 = 0 THEN '  '
                    ELSE 'ORD' || {padded("l.order_id", 8)} END AS order_id,
               strftime(o_orderdate, '%Y-%m-%d') AS order_date,
               'CUS' || {padded("c_custkey", 8)} AS customer_id,
               '  ' || c_name || ' ' AS customer_name,
               ' User' || c_custkey || '@Example.COM ' AS customer_email,
               '08' || {padded("c_custkey", 8)} || '  ' AS customer_phone,
               'P' || {padded("l.product_id", 8)} AS product_id,
               ' ' || p_name || ' ' AS product_name, p_type || ' ' AS category,
               CAST(l.quantity AS VARCHAR) AS quantity, CAST(l.unit_price AS VARCHAR) AS unit_price,
               CAST(CAST(l.discount * 100 AS DECIMAL(6,2)) AS VARCHAR) AS discount_pct,
               '  ' || o_orderpriority || ' ' AS payment_method, o_orderstatus || '   ' AS shipping_status,
               ' ' || n_name || ' ' AS province,
               CAST(CAST(round(l.quantity * l.unit_price * (1 - l.discount), 2) AS DECIMAL(18,2)) AS VARCHAR)
                   AS total_amount,
               'part_' || (l.line_number % 3) || '.csv' AS source_file, l.line_number,
               row_number() OVER (ORDER BY l.order_id, l.line_number, l.product_id, l.supplier_id, l.ship_date,
                                  l.raw_price) AS bronze_id,
               l.order_id AS at_order_id
        FROM lines l JOIN orders ON l.order_id = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN part ON l.product_id = p_partkey""",
    "damaged": """
        SELECT * REPLACE (
            CASE line_number WHEN 1 THEN quantity || '.7' WHEN 2 THEN 'n/a' WHEN 3 THEN '  ' || quantity || ' '
                 ELSE quantity END AS quantity,
            CASE line_number WHEN 4 THEN unit_price || 'x' WHEN 5 THEN 'NaN' WHEN 6 THEN unit_price || '5'
                 ELSE unit_price END AS unit_price,
            CASE line_number WHEN 2 THEN '100' ELSE discount_pct END AS discount_pct,
            CASE line_number WHEN 7 THEN 'not a date' ELSE order_date END AS order_date)
        FROM raw""",
    "silver": """
        SELECT * EXCLUDE (line_number, bronze_id, at_order_id) REPLACE (
            CAST(order_date AS DATE) AS order_date, CAST(quantity AS BIGINT) AS quantity,
            CAST(unit_price AS DECIMAL(18,2)) AS unit_price, CAST(total_amount AS DECIMAL(18,2)) AS total_amount,
            CAST(discount_pct AS DECIMAL(7,4)) AS discount_pct, lower(trim(customer_email)) AS customer_email,
            trim(customer_name) AS customer_name, trim(customer_phone) AS customer_phone,
            trim(product_name) AS product_name, trim(category) AS category, trim(province) AS province,
            trim(payment_method) AS payment_method, trim(shipping_status) AS shipping_status)
        FROM raw WHERE trim(order_id) <> ''
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY source_file, bronze_id) = 1""",
    "headers": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'shipped' ELSE 'pending' END AS order_status,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'credit' WHEN '2' THEN 'cod' ELSE 'promptpay' END
                   AS payment_method,
               CASE o_orderkey % 5 WHEN 0 THEN 'PCT10' WHEN 1 THEN 'FIX500' WHEN 2 THEN 'PCT20' END AS wanted
        FROM orders""",
    "items": """
        SELECT l.order_id, l.line_number, l.product_id, l.supplier_id, l.ship_date, l.raw_price,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price, 1 + l.line_number % 3 AS quantity
        FROM lines l JOIN part ON l.product_id = p_partkey""",
    "subtotals": """
        SELECT order_id, CAST(sum(price * quantity) AS DECIMAL(18,2)) AS subtotal FROM items GROUP BY order_id""",
    "baskets": "SELECT h.*, s.subtotal FROM headers h JOIN subtotals s ON h.order_id = s.order_id",
    "coupons": """
        SELECT * FROM (VALUES
            ('PCT10', 'percentage', CAST(10 AS DECIMAL(10,2)), CAST(1000 AS DECIMAL(10,2)),
             DATE '1995-01-01', DATE '1999-12-31'),
            ('FIX500', 'fixed', CAST(500 AS DECIMAL(10,2)), CAST(5000 AS DECIMAL(10,2)),
             DATE '1997-01-01', DATE '2000-12-31'),
            ('PCT20', 'percentage', CAST(20 AS DECIMAL(10,2)), CAST(15000 AS DECIMAL(10,2)),
             DATE '1998-01-01', DATE '2001-12-31'))
        AS t(code, discount_type, value, min_purchase, start_date, end_date)""",
    "offered": """
        SELECT b.order_id, b.subtotal, b.wanted, c.code, c.discount_type,
               least(CASE c.discount_type WHEN 'percentage' THEN CAST(b.subtotal * c.value * 0.01 AS DECIMAL(24,6))
                     ELSE CAST(c.value AS DECIMAL(24,6)) END, CAST(b.subtotal AS DECIMAL(24,6))) AS exact
        FROM baskets b JOIN coupons c ON b.order_date BETWEEN c.start_date AND c.end_date
        WHERE b.subtotal >= c.min_purchase""",
    "eligible": "SELECT * FROM offered WHERE wanted = code",
    "applied": "SELECT order_id, code, exact FROM eligible",
    "applied_auto": """
        SELECT order_id, code, exact FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY exact DESC, code) AS rank
            FROM offered WHERE wanted IS NULL OR wanted = code) WHERE rank = 1""",
    "priced": _priced("applied"),
    "priced_auto": _priced("applied_auto"),
    "log": """
        SELECT event_id AS log_id, user_id AS product_id, ts AS created_at,
               CASE WHEN event_type IN ('signup', 'click') THEN 'inbound'
                    WHEN event_type IN ('purchase', 'view') THEN 'outbound' ELSE 'adjustment' END AS log_type,
               CASE WHEN event_type IN ('signup', 'click') THEN CAST(floor(value) AS BIGINT)
                    WHEN event_type IN ('purchase', 'view') THEN -CAST(floor(value) AS BIGINT)
                    WHEN event_id % 2 = 0 THEN CAST(floor(value) AS BIGINT)
                    ELSE -CAST(floor(value) AS BIGINT) END AS change_quantity,
               CASE event_type WHEN 'error' THEN '' ELSE event_type END AS reason
        FROM events""",
    "levels": """
        SELECT product_id, CAST(sum(change_quantity) AS BIGINT) AS quantity, product_id % 20 AS reorder_point
        FROM log GROUP BY product_id""",
    "daily_log": """
        SELECT product_id, CAST(created_at AS DATE) AS day, CAST(sum(change_quantity) AS BIGINT) AS change,
               CAST(sum(CASE WHEN log_type = 'outbound' THEN -change_quantity ELSE 0 END) AS BIGINT) AS outbound
        FROM log GROUP BY ALL""",
    "parcels": f"""
        SELECT o_orderkey AS shipment_id, o_orderkey AS order_id,
               'TH' || {padded("o_orderkey", 14)} AS tracking_number,
               CASE o_orderkey % 6 {_cases(f"'{c}'" for c in CARRIERS)} END AS carrier,
               CAST(CASE o_orderkey % 6 {_cases(map(str, SHIPPING_COSTS))} END AS DECIMAL(10,2)) AS shipping_cost,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipping' ELSE 'preparing' END AS status,
               CAST(o_orderdate AS DATE) AS updated_at
        FROM orders""",
    "bodies": """
        SELECT event_id, user_id AS id,
               CASE WHEN event_id % 17 = 0 THEN
                        CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'high' ELSE NULL END
                    ELSE CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END AS rating_text
        FROM events""",
}


def with_model(sql: str) -> str:
    """Put the model tables a statement names, and theirs, in front of it."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name in set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text)) & set(MODEL) - needed:
            needed.add(name)
            pending.append(MODEL[name])
    if not needed:
        return sql.strip()
    parts = [f"{name} AS ({body.strip()})" for name, body in MODEL.items() if name in needed]
    statement = sql.strip()
    if statement.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + statement[5:]
    return "WITH " + ",\n".join(parts) + "\n" + statement
