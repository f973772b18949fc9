"""Repeatable sample orders, independent of partitioning.

Each field is drawn from an MD5 of (seed, field, id), so a row depends only on
its id: any number of tasks produces the same rows, and so does a retry.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.contracts import CARRIERS, MONEY, PRICE, SHIPPING_COSTS
from granary.functions import text
from granary.operators.ordering import dense_number

# ---------------------------------------------------------------- fixed values
DISCOUNT_CHOICES = [0, 0, 0, 5, 10, 15]
GENERATED_PAYMENTS = ["โอนเงิน", "บัตรเครดิต", "เก็บเงินปลายทาง", "e-Wallet"]
GENERATED_SHIPPING = ["จัดส่งแล้ว", "กำลังจัดส่ง", "รอดำเนินการ", "ส่งสำเร็จ"]
ITEM_WEIGHTS = [(1, 20), (2, 35), (3, 25), (4, 15), (5, 5)]
QUANTITY_WEIGHTS = [(1, 60), (2, 30), (3, 10)]
PAYMENT_WEIGHTS = [("promptpay", 50), ("credit", 30), ("cod", 20)]
ORDER_DISCOUNTS = [(0, 40), (5, 30), (10, 20), (15, 10)]
DISCOUNT_FROM = 1000
# ------------------------------------------------------------ end fixed values


def draw(seed: int, field: str, key: Column, n: int | Column) -> Column:
    """Number in 0..n-1 that depends on seed, field and key only."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(field), key.cast("string")))
    number = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    return number % (F.lit(n) if isinstance(n, int) else n).cast("bigint")


def choice(values: list, picked: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (picked + 1).cast("int"))


def weighted(pairs: Iterable[tuple], picked: Column) -> Column:
    """Value whose share of 0..99 the drawn number falls into."""
    result, bound = None, 0
    for value, weight in pairs:
        bound += weight
        result = F.when(picked < bound, value) if result is None else result.when(picked < bound, value)
    return result


def numbered_catalogue(rows: DataFrame, key: str = "product_id", name: str = "_n") -> DataFrame:
    """Rows with a position 0..n-1 to draw from."""
    return dense_number(rows, [key], name).withColumn(name, F.col(name) - 1)


def order_lines(
    ids: DataFrame, products: DataFrame, seed: int, last_day: str, provinces: DataFrame | None = None
) -> DataFrame:
    """One landing-file order line per id.

    ``products`` needs ``product_id, product_name, category, unit_price`` and
    ``provinces`` one column ``province``; without it the field is NULL.
    """
    catalogue = numbered_catalogue(products)
    size = products.count()
    places = None if provinces is None else numbered_catalogue(provinces, "province", "_place")
    place_count = 1 if provinces is None else provinces.count()
    key = F.col("id")
    drawn = ids.select(
        "id",
        draw(seed, "product", key, size).alias("_n"),
        (draw(seed, "quantity", key, 5) + 1).alias("quantity"),
        choice(DISCOUNT_CHOICES, draw(seed, "discount", key, len(DISCOUNT_CHOICES))).cast("bigint").alias("discount_pct"),
        F.date_sub(F.lit(last_day).cast("date"), draw(seed, "day", key, 366).cast("int")).alias("order_date"),
        choice(GENERATED_PAYMENTS, draw(seed, "payment", key, 4)).alias("payment_method"),
        choice(GENERATED_SHIPPING, draw(seed, "shipping", key, 4)).alias("shipping_status"),
        draw(seed, "province", key, place_count).alias("_place"),
        draw(seed, "phone", key, 100_000_000).cast("string").alias("_phone"),
    )
    amount = F.col("quantity") * F.col("unit_price") * (F.lit(100) - F.col("discount_pct")) * F.expr("0.01BD")
    number = F.col("id").cast("string")
    if places is None:
        drawn = drawn.withColumn("province", F.lit(None).cast("string"))
    else:
        drawn = drawn.join(places, "_place")
    return drawn.join(catalogue, "_n").select(
        F.concat(F.lit("ORD"), text.zero_padded(number, 8)).alias("order_id"),
        "order_date",
        F.concat(F.lit("CUS"), text.zero_padded(number, 8)).alias("customer_id"),
        F.concat(F.lit("ลูกค้า "), number).alias("customer_name"),
        F.concat(F.lit("customer"), number, F.lit("@example.com")).alias("customer_email"),
        F.concat(F.lit("08"), text.zero_padded("_phone", 8)).alias("customer_phone"),
        "product_id",
        "product_name",
        "category",
        "quantity",
        "unit_price",
        "discount_pct",
        "payment_method",
        "shipping_status",
        "province",
        F.round(amount, 2).cast(MONEY).alias("total_amount"),
    )


def order_items(ids: DataFrame, products: DataFrame, seed: int) -> DataFrame:
    """One to five different products per order id, with price and quantity."""
    catalogue = numbered_catalogue(products).select("_n", "product_id", F.col("unit_price").alias("price"))
    size = products.count()
    key = F.col("id")
    # numbers are drawn into columns first, so that each is hashed once
    drawn = ids.select(
        "id",
        draw(seed, "items", key, 100).alias("_items"),
        draw(seed, "first", key, size).alias("_first"),
        # a stride of at most a fifth of the catalogue never meets a product twice
        (draw(seed, "stride", key, max(1, size // 5)) + 1).alias("_stride"),
    )
    wanted = F.least(weighted(ITEM_WEIGHTS, F.col("_items")), F.lit(size))
    slots = drawn.select("id", "_first", "_stride", F.explode(F.sequence(F.lit(0), wanted - 1)).alias("_slot"))
    lines = slots.select(
        F.col("id").alias("order_id"),
        ((F.col("_first") + F.col("_slot") * F.col("_stride")) % F.lit(size)).alias("_n"),
        draw(seed, "quantity", F.concat_ws(":", "id", "_slot"), 100).alias("_quantity"),
    ).withColumn("quantity", weighted(QUANTITY_WEIGHTS, F.col("_quantity")).cast("bigint"))
    return lines.join(catalogue, "_n").select("order_id", "product_id", "price", "quantity")


def orders(
    ids: DataFrame, products: DataFrame, seed: int, completed_ratio: float = 0.8, items: DataFrame | None = None
) -> DataFrame:
    """Priced orders with status and payment drawn by weight.

    ``items`` are the ids' order items, if they are written already.
    """
    if items is None:
        items = order_items(ids, products, seed)
    completed = round(completed_ratio * 100)
    statuses = [("paid", completed), ("shipped", 8), ("pending", 7), ("cancelled", 5)]
    everything = sum(weight for _, weight in statuses)
    key = F.col("order_id")
    totals = items.groupBy("order_id").agg(
        F.count("*").alias("items"), F.sum(F.col("price") * F.col("quantity")).cast(MONEY).alias("total_price")
    )
    drawn = totals.withColumns(
        {
            "_discount": draw(seed, "order_discount", key, 100),
            "_status": draw(seed, "status", key, everything),
            "_payment": draw(seed, "payment", key, 100),
        }
    )
    percent = F.when(F.col("total_price") < DISCOUNT_FROM, 0).otherwise(weighted(ORDER_DISCOUNTS, F.col("_discount")))
    # half to even, as decimal quantisation rounds by default
    discount = F.bround(F.col("total_price") * percent.cast("bigint") * F.expr("0.01BD"), 2).cast(MONEY)
    return drawn.withColumn("discount_applied", discount).select(
        "order_id",
        "items",
        "total_price",
        "discount_applied",
        (F.col("total_price") - F.col("discount_applied")).cast(MONEY).alias("final_price"),
        weighted(statuses, F.col("_status")).alias("status"),
        weighted(PAYMENT_WEIGHTS, F.col("_payment")).alias("payment_method"),
    )


def shipments(made: DataFrame, seed: int) -> DataFrame:
    """A parcel for each paid or shipped order."""
    key = F.col("order_id")
    drawn = made.filter(F.col("status").isin("paid", "shipped")).select(
        "order_id",
        "status",
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("tracking"), key.cast("string"))).alias("_digest"),
        draw(seed, "carrier", key, len(CARRIERS)).alias("_carrier"),
        draw(seed, "cost", key, len(SHIPPING_COSTS)).alias("_cost"),
    )
    return drawn.select(
        "order_id",
        F.concat(F.lit("TH"), F.upper(F.substring("_digest", 1, 14))).alias("tracking_number"),
        choice(CARRIERS, F.col("_carrier")).alias("carrier"),
        choice(SHIPPING_COSTS, F.col("_cost")).cast(PRICE).alias("shipping_cost"),
        F.when(F.col("status") == "paid", "delivered").otherwise("shipping").alias("status"),
    )
