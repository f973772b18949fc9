"""Silver layer: cleaned, typed, deduplicated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.contracts import MONEY, PERCENT, PRICE
from granary.functions import dates, numbers, text
from granary.operators.dedup import dedup_first

TRIMMED = [
    "customer_name", "customer_phone", "product_name", "category",
    "payment_method", "shipping_status", "province",
]


def with_key(bronze: DataFrame) -> DataFrame:
    """Rows whose order id is not blank."""
    return bronze.filter(text.is_present("order_id"))


def cleaned(bronze: DataFrame) -> DataFrame:
    """Trimmed text and lower-case e-mail, other columns unchanged."""
    changes: dict[str, Column] = {name: text.trim_spaces(name) for name in TRIMMED}
    changes["customer_email"] = text.clean_email("customer_email")
    return bronze.withColumns(changes)


def typed(bronze: DataFrame) -> DataFrame:
    """Contract types; text that is no such value becomes NULL."""
    return bronze.withColumns(
        {
            "order_date": numbers.lenient_date("order_date"),
            "quantity": numbers.lenient_long("quantity"),
            "unit_price": numbers.lenient_decimal("unit_price"),
            "discount_pct": numbers.lenient_decimal("discount_pct", PERCENT),
            "total_amount": numbers.lenient_decimal("total_amount"),
        }
    )


def cast_rejects(bronze: DataFrame, row_label: str = "bronze_id") -> DataFrame:
    """Values that are present but could not be typed, one row each."""
    failed = {
        "order_date": text.is_present("order_date") & numbers.lenient_date("order_date").isNull(),
        "quantity": text.is_present("quantity") & numbers.lenient_long("quantity").isNull(),
        "unit_price": numbers.is_bad_number("unit_price"),
        "discount_pct": numbers.is_bad_number("discount_pct", PERCENT),
        "total_amount": numbers.is_bad_number("total_amount"),
    }
    entries = F.array(
        *[
            F.when(bad, F.struct(F.lit(name).alias("field"), F.col(name).alias("value")))
            for name, bad in failed.items()
        ]
    )
    listed = bronze.select(F.col(row_label), F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("bad"))
    return listed.select(row_label, "bad.field", "bad.value")


LINE_GRAIN = ("order_id", "line_number")


def with_line_number(bronze: DataFrame) -> DataFrame:
    """Number the lines of an order within each file, in file order.

    A file that arrives twice under two names repeats its numbers, so that the
    copies meet; two lines of one product in an order stay two.
    """
    lines = Window.partitionBy("source_file", "order_id").orderBy("bronze_id")
    return bronze.withColumn("line_number", F.row_number().over(lines).cast("bigint"))


def build(
    bronze: DataFrame, keys: tuple[str, ...] = ("order_id",), order: tuple[str, ...] = ("source_file", "bronze_id")
) -> DataFrame:
    """Bronze rows to Silver: blank keys out, first row per key, clean and type.

    ``("order_id",)`` keeps one row per order, ``LINE_GRAIN`` every line.
    """
    kept = with_key(bronze)
    if "line_number" in keys and "line_number" not in bronze.columns:
        kept = with_line_number(kept)
    first = dedup_first(kept, list(keys), list(order))
    return typed(cleaned(first)).drop("bronze_id", "source_row", "raw_json")


def products(df: DataFrame) -> DataFrame:
    """``product_id, sku, product_name, price, cost, profit_margin``."""
    return df.select(
        F.col("product_id").cast("bigint").alias("product_id"),
        text.strip_whitespace("sku").alias("sku"),
        text.trim_spaces("product_name").alias("product_name"),
        F.col("price").cast(PRICE).alias("price"),
        F.col("cost").cast(PRICE).alias("cost"),
        numbers.profit_margin(F.col("price").cast(MONEY), F.col("cost").cast(MONEY)).alias("profit_margin"),
    )


def orders(df: DataFrame) -> DataFrame:
    """Order header with lower-case e-mail and a date key."""
    return df.select(
        "order_id",
        text.trim_spaces("customer_name").alias("customer_name"),
        text.clean_email("email").alias("email"),
        "order_status",
        "payment_method",
        dates.date_key("order_date").alias("order_date_key"),
    )


def loyalty_accounts(df: DataFrame) -> DataFrame:
    return df.select("loyalty_id", "points", numbers.loyalty_tier("points").alias("tier"))
