"""Model tables derived from the sample Parquet tables.

Each function takes (spark, folder) and returns one table of the retail model.
Amounts become decimals here, before any arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.contracts import CARRIERS, FRACTION, MONEY, PRICE, SHIPPING_COSTS
from granary.functions import numbers, text
from granary.operators.dedup import dedup_least
from granary.operators.ordering import dense_number

# The line's own number does not identify it; these columns together do.
LINE_ORDER = ["order_id", "line_number", "product_id", "supplier_id", "ship_date", "raw_price"]


SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A sample table; the declared schema saves the job that would infer it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


# ---------------------------------------------------------------- sales model
def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the columns that fix their order."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("l_extendedprice").alias("raw_price"),
        F.col("l_extendedprice").cast(MONEY).alias("unit_price"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_discount").cast(FRACTION).alias("discount"),
    )


DETAIL_COLUMNS = ["order_id", "product_id", "unit_price", "quantity", "discount"]


def order_details(spark: SparkSession, folder: str) -> DataFrame:
    return lines(spark, folder).select(*DETAIL_COLUMNS)


def numbered_details(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their position in the whole table."""
    return dense_number(lines(spark, folder), LINE_ORDER, "line_id").select("line_id", *DETAIL_COLUMNS)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        (F.col("o_orderkey") % 10).alias("shipper_id"),
        F.col("o_totalprice").cast(MONEY).alias("freight"),
    )


def order_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    named = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("company_name"), F.col("n_name").alias("city")
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("p_retailprice").cast(MONEY)
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").cast("bigint").alias("category_id"),
        price.alias("unit_price"),
        (price * F.expr("0.7BD")).cast(MONEY).alias("cost"),
    )


def shippers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("shipper_id"), F.col("s_name").alias("shipper_name")
    )


# ---------------------------------------------------------- landing-file model
def _padded(value: Column, left: str = " ", right: str = " ") -> Column:
    return F.concat(F.lit(left), value, F.lit(right))


def landing_file() -> Column:
    return F.concat(F.lit("part_"), (F.col("line_number") % 3).cast("string"), F.lit(".csv"))


def order_code(order: str) -> Column:
    return F.concat(F.lit("ORD"), text.zero_padded(order, 8))


def product_code(product: str) -> Column:
    return F.concat(F.lit("P"), text.zero_padded(product, 8))


def _written_code() -> Column:
    """The order id as the files have it, blank on some lines."""
    return F.when(F.col("product_id") % 11 == 0, "  ").otherwise(order_code("order_id"))


def landed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines whose product is known."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("product_id"), "p_name", "p_type")
    return lines(spark, folder).join(parts, "product_id")


def first_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The landed line of each order that comes first in its files, among those with an order id.

    Whether order, customer and nation are known is the same for all lines of an
    order, so those tables are met by the survivors alone.
    """
    coded = landed_lines(spark, folder).withColumns({"source_file": landing_file(), "code": _written_code()})
    kept = coded.filter(text.is_present("code")).drop("code")
    return dedup_least(kept, ["order_id"], ["source_file", *LINE_ORDER[1:]]).drop("source_file")


def customer_orders(spark: SparkSession, folder: str, landed: DataFrame | None = None) -> DataFrame:
    """Raw order-file rows: all text, padded, some order ids blank.

    Keeps the line order columns (prefixed ``at_``) in place of a stored row id.
    ``landed`` gives the landed lines to take, if not all.
    """
    landed = landed_lines(spark, folder) if landed is None else landed
    order = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    people = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    flat = (
        landed.join(order, "order_id")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    total = numbers.net_revenue("quantity", "unit_price", "discount")
    key = F.col("c_custkey").cast("string")
    return flat.select(
        _written_code().alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.concat(F.lit("CUS"), text.zero_padded(key, 8)).alias("customer_id"),
        _padded(F.col("c_name"), "  ").alias("customer_name"),
        _padded(F.concat(F.lit("User"), key, F.lit("@Example.COM"))).alias("customer_email"),
        _padded(F.concat(F.lit("08"), text.zero_padded(key, 8)), "", "  ").alias("customer_phone"),
        product_code("product_id").alias("product_id"),
        _padded(F.col("p_name")).alias("product_name"),
        _padded(F.col("p_type"), "").alias("category"),
        F.col("quantity").cast("string").alias("quantity"),
        F.col("unit_price").cast("string").alias("unit_price"),
        (F.col("discount") * 100).cast("decimal(6,2)").cast("string").alias("discount_pct"),
        _padded(F.col("o_orderpriority"), "  ").alias("payment_method"),
        _padded(F.col("o_orderstatus"), "", "   ").alias("shipping_status"),
        _padded(F.col("n_name")).alias("province"),
        total.cast("string").alias("total_amount"),
        landing_file().alias("source_file"),
        "line_number",
        *[F.col(c).alias(f"at_{c}") for c in LINE_ORDER],
    )


BRONZE_ORDER = ["source_file", *[f"at_{c}" for c in LINE_ORDER]]


def damaged_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows with numbers and dates spoilt by line number."""
    line = F.col("line_number")
    return customer_orders(spark, folder).withColumns(
        {
            "quantity": F.when(line == 1, F.concat("quantity", F.lit(".7")))
            .when(line == 2, "n/a")
            .when(line == 3, F.concat(F.lit("  "), "quantity", F.lit(" ")))
            .otherwise(F.col("quantity")),
            "unit_price": F.when(line == 4, F.concat("unit_price", F.lit("x")))
            .when(line == 5, "NaN")
            .when(line == 6, F.concat("unit_price", F.lit("5")))
            .otherwise(F.col("unit_price")),
            "discount_pct": F.when(line == 2, "100").otherwise(F.col("discount_pct")),
            "order_date": F.when(line == 7, "not a date").otherwise(F.col("order_date")),
        }
    )


# ------------------------------------------------------------- operational model
def provinces(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(F.col("n_name").alias("province"))


def order_header(spark: SparkSession, folder: str) -> DataFrame:
    """Order with status, payment method and the coupon code it names, if any."""
    status = F.col("o_orderstatus")
    priority = F.substring("o_orderpriority", 1, 1)
    named = F.col("o_orderkey") % 5
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(status == "F", "paid").when(status == "O", "shipped").otherwise("pending").alias("order_status"),
        F.when(priority == "1", "credit").when(priority == "2", "cod").otherwise("promptpay").alias("payment_method"),
        F.when(named == 0, " pct10 ").when(named == 1, "Fix500").when(named == 2, "PCT20\t").alias("coupon_code"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Basket lines: list price of the product and a quantity of one to three."""
    prices = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").cast(PRICE).alias("price")
    )
    basket = lines(spark, folder).withColumn("quantity", 1 + F.col("line_number") % 3)
    return basket.join(prices, "product_id").select(*LINE_ORDER, "price", "quantity")


def stock_log(spark: SparkSession, folder: str) -> DataFrame:
    """Stock movements; the sign of an adjustment follows the event id."""
    return log_columns(table(spark, folder, "events"))


def log_columns(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    size = F.floor("value").cast("bigint")
    inbound = kind.isin("signup", "click")
    outbound = kind.isin("purchase", "view")
    gain = inbound | (~outbound & (F.col("event_id") % 2 == 0))
    return events.select(
        F.col("event_id").alias("log_id"),
        F.col("user_id").alias("product_id"),
        F.col("ts").alias("created_at"),
        F.when(inbound, "inbound").when(outbound, "outbound").otherwise("adjustment").alias("log_type"),
        F.when(gain, size).otherwise(-size).alias("change_quantity"),
        F.when(kind == "error", "").otherwise(kind).alias("reason"),
    )


def reorder_point(product: str = "product_id") -> Column:
    return F.col(product) % 20


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    pick = (F.col("o_orderkey") % 6 + 1).cast("int")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("shipment_id"),
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("TH"), text.zero_padded("o_orderkey", 14)).alias("tracking_number"),
        F.element_at(F.array(*[F.lit(c) for c in CARRIERS]), pick).alias("carrier"),
        F.element_at(F.array(*[F.lit(c) for c in SHIPPING_COSTS]), pick).cast(PRICE).alias("shipping_cost"),
        F.when(status == "F", "delivered").when(status == "O", "shipping").otherwise("preparing").alias("status"),
        F.col("o_orderdate").cast("date").alias("updated_at"),
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return rating_columns(table(spark, folder, "events"))


def rating_columns(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", F.col("user_id").alias("id"), F.col("value").alias("rating"), F.col("ts").alias("updated_at")
    )


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Rating updates in three notations; every 17th is broken in one of four ways."""
    return payload_columns(table(spark, folder, "events"))


def payload_columns(events: DataFrame) -> DataFrame:
    event = F.col("event_id")
    value = F.col("value").cast("decimal(10,2)").cast("string")
    broken = (
        F.when(event % 4 == 0, "{\"rating\": ")
        .when(event % 4 == 1, "")
        .when(event % 4 == 2, "title=x&rating=high")
        .otherwise("[1, 2]")
    )
    body = (
        F.when(event % 17 == 0, broken)
        .when(event % 3 == 0, F.concat(F.lit('{"id": '), F.col("user_id").cast("string"), F.lit(', "rating": '), value, F.lit("}")))
        .when(event % 3 == 1, F.concat(F.lit("{'rating': '"), value, F.lit("', 'title': 'x'}")))
        .otherwise(F.concat(F.lit("title=a%20b&rating="), value))
    )
    return events.select("event_id", F.col("user_id").alias("id"), body.alias("body"))
