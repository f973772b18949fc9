"""Northwind files to a published view; rules; idempotence; publication."""

from __future__ import annotations

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from granary.contracts import NORTHWIND_TYPES
from granary.operators.quality import QualityError
from granary.plans import northwind, publish
from granary.session import stage
from tests.office_files import write_docx, write_xlsx

ROWS = {
    "customers": [("C1", "Company", "Bangkok")],
    "products": [(1, "Tea", 1, Decimal("10.00"))],
    "orders": [(1, "C1", date(2026, 1, 5), 1, Decimal("100.00"))],
    "order_details": [(1, 1, 1, Decimal("10.00"), 2, Decimal("0.1"))],
    "shippers": [(1, "Flash")],
}


def typed(spark, **extra):
    """The smallest valid set of tables plus extra rows."""
    frames = {}
    for name, types in NORTHWIND_TYPES.items():
        schema = ", ".join(f"{column} {kind}" for column, kind in types.items())
        frames[name] = spark.createDataFrame(ROWS[name] + extra.get(name, []), schema)
    return frames


def broken_rules(spark, **extra):
    found = northwind.find_violations(typed(spark, **extra)).collect()
    return {(row.rule, row.table_name, row.key) for row in found}


def test_valid_set_and_exact_duplicate(spark):
    clean = northwind.validate(typed(spark, customers=ROWS["customers"]))
    assert clean["customers"].count() == 1


def test_conflicting_duplicate_is_rejected(spark):
    data = typed(spark, customers=[("C1", "Company", "Phuket")])
    with pytest.raises(QualityError, match="conflicting_duplicate on customers: 1"):
        northwind.validate(data)


def test_orphans_are_rejected(spark):
    line = (2, 1, 99, Decimal("10"), 1, Decimal("0"))
    with pytest.raises(QualityError, match="orphan on order_details: 1"):
        northwind.validate(typed(spark, order_details=[line]))
    order = (2, "C9", date(2026, 1, 1), 7, Decimal("1"))
    assert broken_rules(spark, orders=[order]) == {("orphan", "orders", "2")}
    assert len(northwind.find_violations(typed(spark, orders=[order])).collect()) == 2


@pytest.mark.parametrize(
    "line",
    [
        (2, 1, 1, Decimal("10"), 2, Decimal("10")),
        (2, 1, 1, Decimal("10"), 0, Decimal("0")),
        (2, 1, 1, Decimal("-1"), 1, Decimal("0")),
        (2, 1, 1, Decimal("10"), 1, Decimal("-0.1")),
        (2, 1, 1, None, 1, Decimal("0")),
    ],
)
def test_bad_measures(spark, line):
    assert broken_rules(spark, order_details=[line]) == {("measure_range", "order_details", "2")}


def test_measure_limits_are_fine(spark):
    lines = [(2, 1, 1, Decimal("0"), 1, Decimal("1")), (3, 1, 1, Decimal("5"), 1, Decimal("0"))]
    assert broken_rules(spark, order_details=lines) == set()


def test_negative_freight_and_missing_key(spark):
    order = (2, "C1", date(2026, 1, 1), 1, Decimal("-1"))
    assert broken_rules(spark, orders=[order]) == {("negative_freight", "orders", "2")}
    assert ("missing_key", "customers", None) in broken_rules(spark, customers=[("", "x", "y")])


def test_empty_table(spark):
    data = typed(spark)
    data["shippers"] = data["shippers"].limit(0)
    rules = {(row.rule, row.table_name) for row in northwind.find_violations(data).collect()}
    assert rules == {("empty_table", "shippers"), ("orphan", "orders")}


@pytest.mark.parametrize("value,broken", [("NaN", True), ("Infinity", True), ("12abc", True), ("10.005", True),
                                          ("10.5", False), (" 10 ", False), ("10.500", False)])
def test_unreadable_numbers(spark, value, broken):
    raw = {
        name: spark.createDataFrame(
            [tuple(None if v is None else str(v) for v in row) for row in ROWS[name]],
            ", ".join(f"{column} string" for column in types),
        )
        for name, types in NORTHWIND_TYPES.items()
    }
    raw["products"] = spark.createDataFrame(
        [("1", "Tea", "1", value)], "product_id string, product_name string, category_id string, unit_price string"
    )
    assert (northwind.unreadable(raw).count() == 1) is broken


def raw_set(spark, **changes):
    """The valid set as text, with some columns of a table replaced."""
    raw = {}
    for name, types in NORTHWIND_TYPES.items():
        rows = [tuple(None if v is None else str(v) for v in row) for row in ROWS[name]]
        raw[name] = spark.createDataFrame(rows, ", ".join(f"{column} string" for column in types))
    for place, value in changes.items():
        table, column = place.split("__")
        raw[table] = raw[table].withColumn(column, F.lit(value).cast("string"))
    return raw


@pytest.mark.parametrize("change,rule", [
    ({"order_details__quantity": "2.7"}, "invalid_number"), ({"order_details__quantity": "2.0"}, None),
    ({"orders__order_date": "not a date"}, "invalid_date"), ({"orders__order_date": "2026-02-30"}, "invalid_date"),
    ({"orders__order_date": " 2026-02-01 "}, None), ({"orders__order_date": None}, "required"),
    ({"orders__freight": " "}, "required"), ({"order_details__discount": None}, "required"),
    ({"products__category_id": "1.5"}, "invalid_number"), ({"customers__city": None}, None),
])
def test_gate_refuses_what_does_not_fit(spark, change, rule):
    rules = {row.rule for row in northwind.unreadable(raw_set(spark, **change)).collect()}
    assert rules == ({rule} if rule else set())


def test_silver_counts_are_checked(spark):
    data = {"a": spark.range(3), "b": spark.range(2)}
    rows = {r.table_name: r.agrees for r in northwind.count_reconciliation(data, {**data, "b": spark.range(1)}).collect()}
    assert rows == {"a": True, "b": False}


# ----------------------------------------------------------------- whole runs
def write_sources(folder, freight=100.0, lines=3):
    folder.mkdir(exist_ok=True)
    (folder / "customers.csv").write_text(
        "﻿CustomerID,CompanyName,ContactName,City,Phone\n"
        'C1," Alpha, Ltd ",Secret Person,Bangkok,0812345678\nC2,Beta,Other Person,Phuket,0898765432\n'
        "C2,Beta,Third Person,Phuket,0800000000\n",
        encoding="utf-8",
    )
    products = [
        {"ProductID": n, "ProductName": f" Product {n} ", "CategoryID": n % 2, "Specs": {"UnitPrice": 10.25 * n}}
        for n in (1, 2)
    ]
    (folder / "products.json").write_text(json.dumps(products), encoding="utf-8")
    write_xlsx(
        folder / "orders_2026.xlsx",
        [
            ["OrderID", "CustomerID", "OrderDate", "ShipperID", "Freight"],
            [1, "C1", date(2024, 12, 30), 3, freight],
            [2, "C2 ", "2026-02-01", 3, 0],
        ],
    )
    body = "".join(f"{1 + n % 2}|{1 + n % 2}|{10.25 * (1 + n % 2)}|{n + 1}|0.15\n" for n in range(lines))
    (folder / "order_details.txt").write_text("﻿OrderID|ProductID|UnitPrice|Quantity|Discount\n" + body)
    write_docx(folder / "shippers_policy.docx", ["Policy", "SHIP_ID: 3 -> Flash Express "])
    return str(folder)


def test_run_publishes_once(spark, tmp_path):
    source, out = write_sources(tmp_path / "in"), str(tmp_path / "lake")
    first = northwind.run(spark, source, out, view="nw_sales")
    view = spark.table("nw_sales")
    rows = view.orderBy("line_id").collect()
    assert [row.line_id for row in rows] == [1, 2, 3]
    assert [row.net_revenue for row in rows] == [Decimal("8.71"), Decimal("34.85"), Decimal("26.14")]
    assert rows[0].city == "Bangkok" and rows[0].shipper_name == "Flash Express" and rows[0].product_name == "Product 1"
    assert not {"ContactName", "Phone", "customer_phone", "contact_name"} & set(view.columns)
    summary = {row.table_name: (row.rows, row.net_revenue) for row in first.summary.collect()}
    assert summary["fact_sales"] == (3, Decimal("69.70")) and summary["customers"][0] == 2

    again = northwind.run(spark, source, out, view="nw_sales")
    assert again.batch == first.batch and spark.table("nw_sales").count() == 3

    write_sources(tmp_path / "in", lines=5)
    changed = northwind.run(spark, source, out, view="nw_sales")
    assert changed.batch != first.batch and spark.table("nw_sales").count() == 5
    assert publish.current_batch(spark, f"{out}/gold") == changed.batch
    assert spark.read.parquet(f"{out}/gold/{first.batch}/fact_sales").count() == 3
    orders = {row.order_id: row for row in spark.read.parquet(f"{out}/gold/{changed.batch}/fact_orders").collect()}
    assert orders[1].freight_including_vat == Decimal("107.00")
    week = spark.read.parquet(f"{out}/gold/{changed.batch}/dim_date").filter("year = 2024").first()
    assert (week.iso_week, week.iso_year) == (1, 2025)
    archived = spark.read.parquet(f"{out}/bronze/{changed.batch}")
    assert archived.count() == 5


def test_invalid_batch_is_not_published(spark, tmp_path):
    source, out = write_sources(tmp_path / "in", freight=-5.0), str(tmp_path / "lake")
    with pytest.raises(QualityError, match="negative_freight"):
        northwind.run(spark, source, out, view="nw_invalid")
    assert publish.current_batch(spark, f"{out}/gold") is None
    assert not spark.catalog.tableExists("nw_invalid")


def test_validate_only_writes_nothing(spark, tmp_path):
    source, out = write_sources(tmp_path / "in"), tmp_path / "lake"
    result = northwind.run(spark, source, str(out), validate_only=True)
    assert result.view is None and not out.exists() and len(result.batch) == 16


def test_missing_source(spark, tmp_path):
    write_sources(tmp_path / "in")
    (tmp_path / "in" / "products.json").unlink()
    with pytest.raises(FileNotFoundError, match="products.json"):
        northwind.read_raw(spark, str(tmp_path / "in"))


def test_reconciliation_sees_a_lost_line(spark):
    data = typed(spark, order_details=[(2, 1, 1, Decimal("3.33"), 3, Decimal("0.05"))])
    from granary.plans.gold import fact_sales

    fact = fact_sales(data["order_details"], data["orders"])
    assert northwind.revenue_reconciliation(data["order_details"], fact).first().agrees
    assert not northwind.revenue_reconciliation(data["order_details"], fact.limit(1)).first().agrees


# ----------------------------------------------------------------- publishing
def test_write_once_repairs_an_unfinished_write(spark, tmp_path):
    path = str(tmp_path / "table")
    publish.write_once(spark.range(3), path)
    assert publish.write_once(spark.range(9), path).count() == 3
    (tmp_path / "table" / "_SUCCESS").unlink()
    assert publish.write_once(spark.range(9), path).count() == 9


def test_staging_count_must_match(spark, tmp_path):
    path = str(tmp_path / "staged")
    publish.stage_typed(spark.range(3), {"id": "bigint"}, path)
    publish.stage_typed(spark.range(3), {"id": "bigint"}, path)
    with pytest.raises(publish.BatchError):
        publish.stage_typed(spark.range(4), {"id": "bigint"}, path)


def test_pointer_moves(spark, tmp_path):
    root = str(tmp_path)
    assert publish.current_batch(spark, root) is None
    for name in ("one", "two"):
        publish.switch_pointer(spark, root, name)
        assert publish.current_batch(spark, root) == name


def test_import_state(spark, tmp_path):
    for folder, content in (("source", {"a": "1", "b": "2", "c": "3"}), ("target", {"a": "1", "b": "x"})):
        (tmp_path / folder).mkdir()
        for name, text in content.items():
            (tmp_path / folder / name).write_text(text)
    state = publish.import_state(spark, str(tmp_path / "source"), str(tmp_path / "target"))
    assert {row.name: row.state for row in state.collect()} == {"a": "same", "b": "conflict", "c": "new"}


def test_staged_rows_survive_their_source(spark):
    assert stage(spark.range(7), "test").count() == 7
