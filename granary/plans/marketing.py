"""Loyalty accounts, coupon facts and customer value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import dates, numbers
from granary.operators.ordering import dense_number
from granary.plans.publish import side_by_side


def loyalty_balances(opening: DataFrame, earned: DataFrame) -> DataFrame:
    """Opening balance plus points earned per account; accounts appear as needed.

    A union and one sum replace a full outer join: partial sums run map-side,
    so one account with very many orders costs one row per task.
    """
    moves = opening.select("phone", "points").unionByName(earned.select("phone", "points"))
    return moves.groupBy("phone").agg(F.sum("points").cast("bigint").alias("points"))


def with_tier(accounts: DataFrame) -> DataFrame:
    return accounts.withColumn("tier", numbers.loyalty_tier("points"))


def loyalty_ranking(accounts: DataFrame) -> DataFrame:
    """Members by points, best first, ties by phone."""
    ordered = accounts.withColumn("_less", -F.col("points"))
    return dense_number(ordered, ["_less", "phone"], "position").drop("_less")


def marketing_stats(coupons: DataFrame, accounts: DataFrame, at: Column) -> DataFrame:
    """Coupons in force at a moment, members and their points, in one row."""
    in_force = F.col("active") & at.between(F.col("start_date"), F.col("end_date"))
    offers = coupons.agg(F.count_if(in_force).alias("active_coupons"))
    members = accounts.agg(
        F.count("*").alias("total_members"), F.coalesce(F.sum("points"), F.lit(0)).cast("bigint").alias("total_points")
    )
    return side_by_side(offers, members)


def times_used(priced_orders: DataFrame) -> DataFrame:
    return priced_orders.filter("coupon is not null").groupBy(F.col("coupon").alias("code")).agg(
        F.count("*").alias("times_used")
    )


def fact_marketing(coupons: DataFrame, priced_orders: DataFrame) -> DataFrame:
    """One row per coupon; unused coupons stay with zero uses."""
    used = times_used(priced_orders)
    return coupons.join(used, "code", "left").select(
        "code",
        dates.date_key("start_date").alias("start_date_key"),
        dates.date_key("end_date").alias("end_date_key"),
        "discount_type",
        F.col("value").alias("discount_value"),
        F.coalesce("times_used", F.lit(0)).cast("bigint").alias("times_used"),
    )


def coupon_windows(forms: DataFrame, as_of: Column, zone: str = dates.BUSINESS_ZONE) -> DataFrame:
    """Start and end of coupons entered as form text.

    A blank start is ``as_of``; a blank end is thirty days after it.
    """
    return forms.withColumn("start_date", dates.form_instant("start_text", as_of, zone)).withColumn(
        "end_date", dates.form_instant("end_text", as_of + F.expr("interval 30 days"), zone)
    )


def dim_customer_tiered(customers: DataFrame, priced_orders: DataFrame) -> DataFrame:
    """Customers with order count, lifetime value and tier; zeroes for no orders."""
    value = priced_orders.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        numbers.total("final_price").alias("total_spent"),
        F.sum("points").cast("bigint").alias("points"),
    )
    joined = customers.join(value, "customer_id", "left")
    return joined.select(
        F.col("customer_id").alias("customer_key"),
        F.col("company_name").alias("customer_name"),
        numbers.loyalty_tier(F.coalesce("points", F.lit(0))).alias("loyalty_tier"),
        F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce("total_spent", F.lit(0)).cast("decimal(18,2)").alias("total_spent"),
    )
