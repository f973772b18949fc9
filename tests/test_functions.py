"""Column expressions at their edges."""

from __future__ import annotations

import json
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from granary.functions import dates, numbers, payload, text


def values(spark, rows, schema, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(column).collect()]


def test_trimming(spark):
    rows = [("  a ",), ("\tb\n",), ("  c　",), ("",), (None,)]
    assert values(spark, rows, "x string", text.trim_spaces("x")) == ["a", "\tb\n", "  c　", "", None]
    assert values(spark, rows, "x string", text.strip_whitespace("x")) == ["a", "b", "c", "", None]
    assert values(spark, rows, "x string", text.is_present("x")) == [True, True, True, False, False]


def test_codes_and_mail(spark):
    assert values(spark, [("\t welcome10 ",)], "x string", text.clean_code("x")) == ["WELCOME10"]
    assert values(spark, [(" A@B.CO ",)], "x string", text.clean_email("x")) == ["a@b.co"]
    assert values(spark, [("TH12", " th12\t"), ("TH12", "TH13")], "a string, b string",
                  text.same_ignoring_case("a", "b")) == [True, False]


def test_display(spark):
    assert values(spark, [(5,), (0,), (-3,)], "x int", text.signed("x")) == ["+5", "0", "-3"]
    assert values(spark, [("a",), ("",), (None,)], "x string", text.text_or_dash("x")) == ["a", "-", "-"]
    assert values(spark, [("cod",), ("cash",)], "x string", text.labelled("x", [("cod", "COD")])) == ["COD", None]


@pytest.mark.parametrize("raw,whole,money", [
    ("  12 ", 12, "12.00"), ("\t7\t", 7, "7.00"), ("12abc", None, None), ("", None, None), ("3.7", 3, "3.70"),
    ("-3.7", -3, "-3.70"), ("NaN", None, None), ("Infinity", None, None), ("2.675", 2, "2.68"), ("0.285", 0, "0.29"),
    ("1e3", 1000, "1000.00"),
])
def test_lenient_casts(spark, raw, whole, money):
    assert values(spark, [(raw,)], "x string", numbers.lenient_long("x")) == [whole]
    assert values(spark, [(raw,)], "x string", numbers.lenient_decimal("x")) == [money and Decimal(money)]


def test_bad_numbers(spark):
    rows = [("NaN",), ("12abc",), ("  ",), (None,), (" 5 ",), ("1.005",), ("1.50",)]
    assert values(spark, rows, "x string", numbers.is_bad_number("x")) == [True, True, False, False, False, False, False]
    assert values(spark, rows, "x string", F.coalesce(numbers.is_overprecise("x"), F.lit(False))) == [
        False, False, False, False, False, True, False]


def test_measures(spark):
    row = [(3, Decimal("0.95"), Decimal("0.1"), Decimal("15"))]
    schema = "q bigint, p decimal(18,2), d decimal(6,4), pct decimal(6,4)"
    assert values(spark, row, schema, numbers.net_revenue("q", "p", "d")) == [Decimal("2.57")]  # 2.565 half up
    assert values(spark, row, schema, numbers.line_total("q", "p")) == [Decimal("2.85")]
    assert values(spark, row, schema, numbers.percent_discount("q", "p", "pct")) == [Decimal("0.43")]
    assert values(spark, row, schema, numbers.with_vat("p")) == [Decimal("1.02")]
    prices = [(Decimal("0"), Decimal("1")), (Decimal("3"), Decimal("2"))]
    assert values(spark, prices, "p decimal(18,2), c decimal(18,2)", numbers.profit_margin("p", "c")) == [
        None, Decimal("0.3333")]


def test_tiers_and_points(spark):
    assert values(spark, [(499,), (500,), (999,), (1000,)], "x int", numbers.loyalty_tier("x")) == [
        "Silver", "Gold", "Gold", "Platinum"]
    assert values(spark, [(Decimal("99.99"),), (Decimal("100"),), (Decimal("250.5"),)], "x decimal(18,2)",
                  numbers.loyalty_points("x")) == [0, 1, 2]


def test_calendar(spark):
    rows = [(date(2024, 12, 30),), (date(2026, 1, 3),), (date(2026, 1, 4),), (date(2026, 10, 1),)]
    assert values(spark, rows, "d date", dates.date_key("d")) == [20241230, 20260103, 20260104, 20261001]
    assert values(spark, rows, "d date", dates.iso_week("d"))[0] == 1
    assert values(spark, rows, "d date", dates.iso_year("d"))[0] == 2025
    assert values(spark, rows, "d date", dates.is_weekend("d")) == [False, True, True, False]
    assert values(spark, rows, "d date", dates.thai_fiscal_year("d")) == [2568, 2569, 2569, 2570]


def test_form_instants(spark):
    default = F.lit("2026-01-01 00:00:00").cast("timestamp")
    rows = [("2026-05-01T09:30",), (" ",), (None,), ("01/05/2026",)]
    assert values(spark, rows, "x string", dates.form_instant("x", default).cast("timestamp_ntz")) == [
        datetime(2026, 5, 1, 2, 30), datetime(2026, 1, 1), datetime(2026, 1, 1), None]
    instants = [(datetime(2026, 1, 1, 18, 0),)]
    assert values(spark, instants, "t timestamp", dates.business_day("t")) == [date(2026, 1, 2)]


@pytest.mark.parametrize("body,rating,error", [
    ('{"rating": 9.6}', 9.6, None),
    ('{"rating": "9.6", "title": "x"}', 9.6, None),
    ("{'rating': 8}", 8.0, None),
    ("{'rating': 5, 'title': None}", 5.0, None),
    ("{'title': 'None, True', 'seen': True, 'new': False, 'rating': '7'}", 7.0, None),
    ("{'rating': None}", None, "rating is required"),
    ("{'rating': 'None'}", None, "rating must be a number"),
    ('{"rating": 3, "note": "it\'s None"}', 3.0, None),
    ("rating=9.6", 9.6, None),
    ("title=a%20b&rating=7%2E5", 7.5, None),
    ("rating=1&rating=2", 2.0, None),
    ("rating=", None, "rating must be a number"),
    ("rating=high", None, "rating must be a number"),
    ("rating=%zz", None, "rating must be a number"),
    ('{"rating": "9.5d"}', None, "rating must be a number"),
    ('{"rating": null}', None, "rating is required"),
    ('{"title": "x"}', None, "rating is required"),
    ('{"rating": ', None, "rating is required"),
    ("[1, 2]", None, "rating is required"),
    ("underrating=5", None, "rating is required"),
    ("", None, "rating is required"),
    (None, None, "rating is required"),
])
def test_payloads(spark, body, rating, error):
    frame = spark.createDataFrame([(body,)], "body string").withColumn("t", payload.rating_text("body"))
    assert frame.select(payload.rating_value("t"), payload.rating_error("t")).first() == (rating, error)


def test_payload_texts_come_back_unchanged(spark):
    """Bodies of both notations with quotes, escapes, literals, control characters and marks inside texts."""
    draw = random.Random(11)
    pieces = ["None", "True", " False ", "'", '"', "\\", "\u0001", "\u0001None\u0001", "a", "{", "}", ":", ",", "\t", "\x7f", "é", "rating", "x41", "u0022"]
    rows = []
    for number in range(600):
        made = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 8)))
        value = draw.choice([made, None, 7, 2.5])
        body = {"title": "".join(draw.choice(pieces) for _ in range(5)), "deep": [None, True, {"k": False, "t": made}], "rating": value, "z": None}
        notation = draw.choice([json.dumps, repr, lambda b: json.dumps(b, ensure_ascii=False)])
        rows.append((number, notation(body), None if value is None else str(value)))
    rows.append((600, "{'rating': 'a\u0001b\u0002c', 'other': None}", "a\u0001b\u0002c"))
    rows.append((601, '{"other": "' + r'\\\"' * 100_000 + "None" * 50_000 + '", "rating": 4}', "4"))
    rows.append((602, "{'other': [" + "None, 'x', " * 50_000 + "True], 'rating': 'end'}", "end"))
    rows.append((603, "{'other': 'open, 'rating': None}", None))
    frame = spark.createDataFrame([row[:2] for row in rows], "n int, body string")
    found = {row.n: row.t for row in frame.select("n", payload.rating_text("body").alias("t")).collect()}
    assert [(n, body) for n, body, wanted in rows if found[n] != wanted] == []
