"""Trimming, normalising and label expressions over text columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim_spaces(value: ColumnOrName) -> Column:
    """Drop leading and trailing spaces only; tabs and newlines stay."""
    return F.trim(_col(value))


# every character that Unicode counts as whitespace
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_whitespace(value: ColumnOrName) -> Column:
    """Drop every kind of leading and trailing whitespace."""
    return F.btrim(_col(value), F.lit(WHITESPACE))


def clean_email(value: ColumnOrName) -> Column:
    return F.lower(trim_spaces(value))


def clean_code(value: ColumnOrName) -> Column:
    """Codes and SKUs: stripped and upper-cased."""
    return F.upper(strip_whitespace(value))


def is_present(value: ColumnOrName) -> Column:
    """True when the text holds something besides spaces."""
    return F.nullif(trim_spaces(value), F.lit("")).isNotNull()


def same_ignoring_case(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Case-insensitive equality against stripped input."""
    return F.lower(_col(left)) == F.lower(strip_whitespace(right))


def zero_padded(value: ColumnOrName, width: int) -> Column:
    """Number as text with leading zeros up to ``width``; a longer one stays whole."""
    digits = _col(value).cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def text_or_dash(value: ColumnOrName) -> Column:
    return F.coalesce(F.nullif(_col(value), F.lit("")), F.lit("-"))


def signed(value: ColumnOrName) -> Column:
    """Number as text with an explicit plus sign for gains."""
    number = _col(value)
    return F.concat(F.when(number > 0, "+").otherwise(""), number.cast("string"))


def labelled(value: ColumnOrName, labels: Iterable[tuple]) -> Column:
    """Value looked up in a short fixed label table; NULL when it is not listed."""
    pairs = [F.lit(part) for pair in labels for part in pair]
    return F.try_element_at(F.create_map(*pairs), _col(value))
