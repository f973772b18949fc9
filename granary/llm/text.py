"""Column expressions over text that several corpus operators share.

A word is a longest run of characters other than space and the control
characters tab to carriage return; letters keep their case.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def whole(column: str | Column) -> Column:
    """The text, empty where it is null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for a text without words."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computing ``value`` once per row even inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
