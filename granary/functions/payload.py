"""Rating payloads: JSON, single-quoted mappings or form encoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.text import ColumnOrName, _col


NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?(nan|inf|infinity)$"


_MARK = "\u0001"
# escapes that would hide where a quoted text ends, the mark, and bytes as the other notation writes them
_ESCAPES = (("\\\\", "\\u005c"), ('\\"', "\\u0022"), ("\\'", "\\u0027"), ("\\x", "\\u00"), (_MARK, "\\u0001"))
_LITERALS = (("None", "null"), ("True", "true"), ("False", "false"))
# a quoted text, or a literal of the other notation standing outside of quotes
_TOKEN = r"""("[^"]*+"|'[^']*+')|\b(None|True|False)\b"""


def _as_json(raw: Column) -> Column:
    """A mapping of either notation with escapes and literals as JSON writes them.

    Once no escape holds a quote or the mark, one pass tells literals from quoted
    texts; a mark then stands around each literal and nowhere else.
    """
    for escape, unicode in _ESCAPES:
        raw = F.replace(raw, F.lit(escape), F.lit(unicode))
    raw = F.regexp_replace(raw, _TOKEN, f"$1{_MARK}$2{_MARK}")
    for literal, json in (*_LITERALS, ("", "")):
        raw = F.replace(raw, F.lit(f"{_MARK}{literal}{_MARK}"), F.lit(json))
    return raw


def rating_text(body: ColumnOrName) -> Column:
    """The ``rating`` entry as text whichever way the body was encoded.

    Spark's JSON reader takes single quotes as well, so one parse covers both
    mapping notations once their escapes and literals agree; texts come back unchanged, control
    characters too. A body that is no mapping is read as form encoding, where the last of several
    entries counts; an unreadable one gives NULL.
    """
    raw = _col(body)
    options = {"allowUnquotedControlChars": "true"}
    mapping = F.from_json(_as_json(raw), "rating string", options).getField("rating")
    entries = F.regexp_extract_all(raw, F.lit(r"(?:^|&)rating=([^&]*)"), F.lit(1))
    form = F.try_element_at(entries, F.lit(-1))
    return (
        F.when(raw.rlike(r"^\s*\{"), mapping)
        .when(raw.rlike(r"^\s*\["), F.lit(None).cast("string"))
        .otherwise(F.coalesce(F.try_url_decode(form), form))
    )


def _is_number(text: Column) -> Column:
    return F.trim(text).rlike(NUMBER)


def rating_error(text: ColumnOrName) -> Column:
    """Why a rating is refused; NULL when it is a number."""
    value = _col(text)
    return F.when(value.isNull(), "rating is required").when(~_is_number(value), "rating must be a number")


def rating_value(text: ColumnOrName) -> Column:
    value = _col(text)
    return F.when(_is_number(value), F.trim(value).try_cast("double"))
