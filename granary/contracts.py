"""Declared schemas, enumerations and fixed label tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MONEY = "decimal(18,2)"
FRACTION = "decimal(6,4)"
PERCENT = "decimal(7,4)"
PRICE = "decimal(10,2)"
MARGIN = "decimal(10,4)"

# ---------------------------------------------------------------- fixed values
ORDER_FIELDS = [
    "order_id", "order_date", "customer_id", "customer_name", "customer_email",
    "customer_phone", "product_id", "product_name", "category", "quantity",
    "unit_price", "discount_pct", "payment_method", "shipping_status", "province",
    "total_amount",
]
BRONZE_METADATA = ["bronze_id", "source_file", "source_row", "extracted_at", "raw_json"]
LANDING_FILES = (
    "customer_orders.csv", "customer_orders.json", "customer_orders.txt",
    "customer_orders.xlsx", "customer_orders.docx",
)
NORTHWIND_FILES = (
    "customers.csv", "products.json", "orders_2026.xlsx",
    "order_details.txt", "shippers_policy.docx",
)

ORDER_STATUS = ["pending", "paid", "shipped", "cancelled"]
PAYMENT_METHODS = ["credit", "promptpay", "cod"]
SHIPMENT_STATUS = ["preparing", "shipping", "delivered", "returned"]
STOCK_LOG_TYPES = ["inbound", "outbound", "adjustment"]
DISCOUNT_TYPES = ["percentage", "fixed"]

PAYMENT_LABELS = [
    ("credit", "บัตรเครดิต/เดบิต"),
    ("promptpay", "QR PromptPay"),
    ("cod", "เก็บเงินปลายทาง (COD)"),
]
CARRIERS = ["Kerry Express", "Flash Express", "EMS Thailand", "J&T Express", "DHL Express", "Ninja Van"]
SHIPPING_COSTS = [0, 50, 80, 100, 150, 200]
FLAT_SHIPPING = 50

MONTHS_TH = [
    (1, "มกราคม"), (2, "กุมภาพันธ์"), (3, "มีนาคม"), (4, "เมษายน"),
    (5, "พฤษภาคม"), (6, "มิถุนายน"), (7, "กรกฎาคม"), (8, "สิงหาคม"),
    (9, "กันยายน"), (10, "ตุลาคม"), (11, "พฤศจิกายน"), (12, "ธันวาคม"),
]
# day number as Spark's dayofweek counts: 1 = Sunday
DAYS_TH = [
    (1, "อาทิตย์"), (2, "จันทร์"), (3, "อังคาร"), (4, "พุธ"),
    (5, "พฤหัสบดี"), (6, "ศุกร์"), (7, "เสาร์"),
]

PLATINUM_POINTS = 1000
GOLD_POINTS = 500
POINT_VALUE = 100  # one loyalty point per 100 of final price

# code, type, value, minimum purchase, first day, last day
COUPONS = [
    ("PCT10", "percentage", "10.00", "1000.00", "1995-01-01", "1999-12-31"),
    ("FIX500", "fixed", "500.00", "5000.00", "1997-01-01", "2000-12-31"),
    ("PCT20", "percentage", "20.00", "15000.00", "1998-01-01", "2001-12-31"),
]
NORTHWIND_TYPES = {
    "customers": {"customer_id": "string", "company_name": "string", "city": "string"},
    "products": {"product_id": "bigint", "product_name": "string", "category_id": "bigint", "unit_price": MONEY},
    "orders": {
        "order_id": "bigint", "customer_id": "string", "order_date": "date",
        "shipper_id": "bigint", "freight": MONEY,
    },
    "order_details": {
        "line_id": "bigint", "order_id": "bigint", "product_id": "bigint",
        "unit_price": MONEY, "quantity": "bigint", "discount": FRACTION,
    },
    "shippers": {"shipper_id": "bigint", "shipper_name": "string"},
}
NORTHWIND_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "shippers": "shipper_id",
}

# Operational tables snapshotted into Bronze.
OPERATIONAL_TABLES = {
    "products": "storefront_product",
    "orders": "storefront_order",
    "order_items": "storefront_orderitem",
    "stock_levels": "inventory_stocklevel",
    "stock_logs": "inventory_stocklog",
    "coupons": "marketing_coupon",
    "loyalty_accounts": "marketing_loyaltyaccount",
    "shipments": "logistics_shipment",
}
# ------------------------------------------------------------ end fixed values


def coupon_table(spark: SparkSession) -> DataFrame:
    """The fixed coupon rows, typed."""
    rows = spark.createDataFrame(
        COUPONS, "code string, discount_type string, value string, min_purchase string, start_date string, end_date string"
    )
    return rows.selectExpr(
        "code",
        "discount_type",
        f"cast(value as {PRICE}) as value",
        f"cast(min_purchase as {PRICE}) as min_purchase",
        "true as active",
        "cast(start_date as date) as start_date",
        "cast(end_date as date) as end_date",
    )
