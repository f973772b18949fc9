"""Exact money, lenient casts and derived measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.contracts import GOLD_POINTS, MARGIN, MONEY, PLATINUM_POINTS, POINT_VALUE
from granary.functions.text import ColumnOrName, _col, is_present, strip_whitespace


def money(value: Column) -> Column:
    """Rounded half up to two places and typed as money."""
    return F.round(value, 2).cast(MONEY)


def total(value: ColumnOrName) -> Column:
    """Sum of a money column, typed as money again."""
    return F.sum(_col(value)).cast(MONEY)


def lenient_decimal(value: ColumnOrName, kind: str = MONEY) -> Column:
    """Number in text, surrounding blanks allowed; NULL when it is none."""
    return _col(value).try_cast(kind)


def lenient_long(value: ColumnOrName) -> Column:
    """Whole part of numeric text, NULL when it is no number.

    Text such as ``3.7`` does not cast to an integer directly and takes the
    way through a decimal.
    """
    text = _col(value)
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"))


def lenient_date(value: ColumnOrName) -> Column:
    return _col(value).try_cast("date")


def is_bad_number(value: ColumnOrName, kind: str = MONEY) -> Column:
    """Text is there but is not a finite number of this type."""
    return is_present(value) & lenient_decimal(value, kind).isNull()


def is_overprecise(value: ColumnOrName, scale: int = 2) -> Column:
    """The number carries more decimals than the contract keeps."""
    exact = _col(value).try_cast("decimal(38,12)")
    return exact != F.round(exact, scale)


def is_not_whole(value: ColumnOrName) -> Column:
    """Text is there but is no whole number."""
    exact = _col(value).try_cast("decimal(38,12)")
    return is_present(value) & F.coalesce(exact != F.floor(exact), F.lit(True))


def is_not_a_date(value: ColumnOrName) -> Column:
    """Text is there but is neither a date nor a date with a time of day."""
    return is_present(value) & strip_whitespace(value).try_cast("timestamp").isNull()


def line_total(quantity: ColumnOrName, price: ColumnOrName) -> Column:
    return money(_col(quantity) * _col(price))


def percent_discount(quantity: ColumnOrName, price: ColumnOrName, percent: ColumnOrName) -> Column:
    """Discount amount of a line whose discount is a percentage (0..100)."""
    return money(_col(quantity) * _col(price) * _col(percent) / F.lit(100))


def net_revenue(quantity: ColumnOrName, price: ColumnOrName, fraction: ColumnOrName) -> Column:
    """Line revenue where the discount is a fraction (0..1)."""
    return money(_col(quantity) * _col(price) * (F.lit(1) - _col(fraction)))


def with_vat(amount: ColumnOrName) -> Column:
    return money(_col(amount) * F.expr("1.07BD"))


def profit_margin(price: ColumnOrName, cost: ColumnOrName) -> Column:
    """(price - cost) / price; NULL for a free product."""
    return F.round((_col(price) - _col(cost)) / F.nullif(_col(price), F.lit(0).cast(MONEY)), 4).cast(MARGIN)


def loyalty_points(final_price: ColumnOrName) -> Column:
    return F.floor(_col(final_price) / F.lit(POINT_VALUE)).cast("bigint")


def loyalty_tier(points: ColumnOrName, platinum: int = PLATINUM_POINTS, gold: int = GOLD_POINTS) -> Column:
    return F.when(_col(points) >= platinum, "Platinum").when(_col(points) >= gold, "Gold").otherwise("Silver")
