"""Order pricing: subtotals, coupons, discounts and loyalty points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary import session
from granary.contracts import FLAT_SHIPPING, MONEY
from granary.functions import numbers, text
from granary.operators import intervals

PRICE_EXACT = "decimal(24,6)"


def order_subtotals(items: DataFrame) -> DataFrame:
    """Basket value per order."""
    return items.groupBy("order_id").agg(numbers.total(F.col("price") * F.col("quantity")).alias("subtotal"))


def _discount(subtotal: Column, kind: Column, value: Column) -> Column:
    """Percentage of the subtotal or a fixed amount, never above the subtotal."""
    percentage = (subtotal * value * F.expr("0.01BD")).cast(PRICE_EXACT)
    return F.least(F.when(kind == "percentage", percentage).otherwise(value.cast(PRICE_EXACT)),
                   subtotal.cast(PRICE_EXACT))


def _in_force(at: str) -> Column:
    """Whether a coupon is valid then; a missing end leaves that side open."""
    return F.coalesce(F.col(at) >= F.col("start_date"), F.lit(True)) & F.coalesce(
        F.col(at) <= F.col("end_date"), F.lit(True)
    )


def _wanted() -> Column:
    return F.nullif(text.clean_code("coupon_code"), F.lit(""))


OFFER = ["code", "discount_type", "value", "min_purchase"]


def valid_coupons(orders: DataFrame, coupons: DataFrame, at: str = "order_date") -> DataFrame:
    """Orders with the coupon they name, if it is in force at the time of the order.

    An equality join on the code, which is unique: at most one row per order,
    whatever the number of coupons and however long they run.
    """
    active = coupons.filter("active").select(*OFFER, "start_date", "end_date")
    return orders.join(active, _wanted() == F.col("code")).filter(_in_force(at)).select(*orders.columns, *OFFER)


def eligible_coupons(baskets: DataFrame, coupons: DataFrame, at: str = "order_date") -> DataFrame:
    """Valid named coupons whose minimum purchase the basket reaches, with the discount."""
    reached = valid_coupons(baskets, coupons, at).filter(F.col("subtotal") >= F.col("min_purchase"))
    discount = _discount(F.col("subtotal"), F.col("discount_type"), F.col("value"))
    return reached.withColumn("discount", numbers.money(discount))


def best_offers(coupons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bounds of the coupons' windows, and per interval between them and minimum-purchase step the best coupons.

    ``interval, low, high, pct, fixed``: the best percentage and the best fixed
    coupon for subtotals from ``low`` to below ``high``. Windows are taken to
    the microsecond. The coupons of a piece of the interval tree are reduced to
    their steps before intervals meet them, and only steps that improve an
    offer are kept, so many coupons or long ones make no many rows.
    """
    running = coupons.filter("active and min_purchase is not null").select(*OFFER, "start_date", "end_date")
    edges = intervals.bounds(running, "start_date", "end_date")
    levels = intervals.levels_for(edges)
    # the higher value wins, then the lower code: both in one minimum
    rank = F.struct((-F.col("value")).alias("less"), "code", "value")
    by_piece = (
        intervals.pieces(intervals.ranked(running, edges, "start_date", "end_date"), levels)
        .groupBy("_level", "_node", "min_purchase")
        .agg(
            F.min(F.when(F.col("discount_type") == "percentage", rank)).alias("pct"),
            F.min(F.when(F.col("discount_type") == "fixed", rank)).alias("fixed"),
        )
    )
    numbers_of = edges.select(F.col("rank").alias("interval")).unionByName(edges.sparkSession.range(1).select(F.col("id").alias("interval")))
    steps = (
        intervals.ancestors(numbers_of, "interval", levels)
        .join(by_piece, ["_level", "_node"])
        .groupBy("interval", "min_purchase")
        .agg(F.min("pct").alias("pct"), F.min("fixed").alias("fixed"))
    )
    up_to = Window.partitionBy("interval").orderBy("min_purchase").rowsBetween(Window.unboundedPreceding, 0)
    best = steps.select(
        "interval", F.col("min_purchase").alias("low"), F.min("pct").over(up_to).alias("pct"),
        F.min("fixed").over(up_to).alias("fixed"),
    )
    by_low = Window.partitionBy("interval").orderBy("low")
    same = F.lag("pct").over(by_low).eqNullSafe(F.col("pct")) & F.lag("fixed").over(by_low).eqNullSafe(F.col("fixed"))
    better = best.withColumn("_same", same & F.lag("low").over(by_low).isNotNull()).filter("not _same")
    return edges, better.select("interval", "low", F.lead("low").over(by_low).alias("high"), "pct", "fixed")


def _priced_by(baskets: DataFrame, exact: Column, code: Column) -> DataFrame:
    """Discount, final price, price with shipping and points from an exact discount."""
    final = F.col("subtotal") - F.col("_exact")
    kept = [c for c in baskets.columns if c != "coupon_code" and not c.startswith("_")]
    return baskets.withColumns({"coupon": code, "_exact": F.coalesce(exact, F.lit(0).cast(PRICE_EXACT))}).select(
        *kept,
        "coupon",
        numbers.money(F.col("_exact")).alias("discount"),
        numbers.money(final).alias("final_price"),
        numbers.money(final + F.lit(FLAT_SHIPPING)).alias("total_with_shipping"),
        numbers.loyalty_points(final).alias("points"),
    )


def priced(baskets: DataFrame, coupons: DataFrame, at: str = "order_date", auto_apply: bool = False) -> DataFrame:
    """Coupon applied, discount, final price and points of each basket.

    A basket gets the coupon it names, if that is in force and the minimum is
    reached, or none. With ``auto_apply`` a basket that names none gets the
    better of the best percentage and the best fixed coupon in force at its
    time, ties by code; without a time it gets none.
    """
    columns = list(baskets.columns)
    active = coupons.filter("active").select(
        *[F.col(c).alias(f"_{c}") for c in OFFER], F.col("start_date").alias("_from"), F.col("end_date").alias("_to")
    )
    usable = (
        F.coalesce(F.col(at) >= F.col("_from"), F.lit(True))
        & F.coalesce(F.col(at) <= F.col("_to"), F.lit(True))
        & (F.col("subtotal") >= F.col("_min_purchase"))
    )
    named = baskets.filter(_wanted().isNotNull()) if auto_apply else baskets
    joined = named.join(active, (_wanted() == F.col("_code")) & usable, "left")
    exact = _discount(F.col("subtotal"), F.col("_discount_type"), F.col("_value"))
    result = _priced_by(joined, F.when(F.col("_code").isNotNull(), exact), F.col("_code"))
    if not auto_apply:
        return result

    open_baskets = baskets.filter(_wanted().isNull())
    edges, offers = best_offers(coupons)
    offers = session.stage(
        offers.select(*[F.col(c).alias(f"_{c}") for c in ("interval", "low", "high", "pct", "fixed")]), "best-offers"
    )
    placed = session.stage(intervals.interval_of(open_baskets, edges, at, "_at_interval"), "open-baskets")
    within = (F.col("subtotal") >= F.col("_low")) & (F.col("_high").isNull() | (F.col("subtotal") < F.col("_high")))
    found = placed.join(offers, (F.col("_at_interval") == F.col("_interval")) & within, "left")

    def offer(name: str, kind: str) -> Column:
        cost = -_discount(F.col("subtotal"), F.lit(kind), F.col(f"_{name}.value"))
        return F.when(F.col(f"_{name}").isNotNull(), F.struct(cost.alias("cost"), F.col(f"_{name}.code").alias("code")))

    best = found.withColumn("_best", F.least(offer("pct", "percentage"), offer("fixed", "fixed")))
    auto = _priced_by(best.select(*columns, "_best"), -F.col("_best.cost"), F.col("_best.code"))
    return result.unionByName(auto)


def points_earned(priced_orders: DataFrame) -> DataFrame:
    """Orders that earn at least one point."""
    return priced_orders.filter("points > 0").select("order_id", "customer_id", "points")


def baskets(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order headers with their subtotal.

    Items shrink to one row per order before they meet the headers, and both
    steps share one partitioning on the order.
    """
    return order_subtotals(items).join(orders, "order_id").withColumn("subtotal", F.col("subtotal").cast(MONEY))
