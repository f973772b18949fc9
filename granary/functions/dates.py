"""Calendar keys, labels and business-zone timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.text import ColumnOrName, _col, is_present, strip_whitespace

BUSINESS_ZONE = "Asia/Bangkok"


def date_key(day: ColumnOrName) -> Column:
    """YYYYMMDD as a number."""
    d = _col(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def is_weekend(day: ColumnOrName) -> Column:
    return F.dayofweek(_col(day)).isin(1, 7)


def iso_week(day: ColumnOrName) -> Column:
    return F.weekofyear(_col(day)).cast("bigint")


def iso_year(day: ColumnOrName) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _col(day)).cast("bigint")


def thai_fiscal_year(day: ColumnOrName) -> Column:
    """Buddhist-era budget year, which starts in October."""
    d = _col(day)
    return (F.year(d) + 543 + F.when(F.month(d) >= 10, 1).otherwise(0)).cast("bigint")


def business_day(instant: ColumnOrName, zone: str = BUSINESS_ZONE) -> Column:
    """Calendar day of a UTC instant in the shop's own zone."""
    return F.to_date(F.from_utc_timestamp(_col(instant), zone))


def form_instant(text: ColumnOrName, default: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Form input ``YYYY-MM-DDTHH:MM`` in the business zone as a UTC instant.

    Blank input takes the default; text in another form gives NULL.
    """
    parsed = F.to_utc_timestamp(F.try_to_timestamp(strip_whitespace(text), F.lit("yyyy-MM-dd'T'HH:mm")), zone)
    return F.when(is_present(text), parsed).otherwise(default)
