"""Landing files to Bronze: every format, positions, lineage, raw payload."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from granary.contracts import OPERATIONAL_TABLES, ORDER_FIELDS
from granary.operators.keys import file_positions
from granary.plans import bronze, medallion
from granary.sources import files, office, tables
from tests.office_files import write_docx, write_xlsx


def order(number: int, **changes) -> dict:
    record = {name: f"{name}-{number}" for name in ORDER_FIELDS}
    record.update(order_id=f"ORD{number:08d}", quantity=str(number), customer_name="สมชาย ใจดี", unit_price="185.0")
    return {**record, **changes}


@pytest.fixture
def landing(tmp_path):
    csv_rows = [order(1), order(2, customer_name='Doe, "Jane"'), order(3, province="two\nlines"), order(4, category="")]
    lines = [",".join(ORDER_FIELDS)]
    for row in csv_rows:
        lines.append(",".join('"' + row[name].replace('"', '""') + '"' for name in ORDER_FIELDS))
    (tmp_path / "customer_orders.csv").write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    array = [order(11, quantity=3, unit_price=48.0), {**order(12), "extra": "kept"}]
    (tmp_path / "customer_orders.json").write_text(json.dumps(array, ensure_ascii=False, indent=2), encoding="utf-8")
    missing = order(22)
    del missing["province"]
    text = "\n".join(json.dumps(row, ensure_ascii=False) for row in [order(21), missing, order(23)])
    (tmp_path / "customer_orders.txt").write_text(text.replace("\n", "\n\n") + "\n   \n", encoding="utf-8")
    table = [ORDER_FIELDS] + [[order(n)[f] for f in ORDER_FIELDS] for n in (31, 32)]
    table[1][ORDER_FIELDS.index("order_date")] = date(2026, 3, 9)
    table[2][ORDER_FIELDS.index("order_date")] = "inline:2026-03-10"
    table[2][ORDER_FIELDS.index("quantity")] = 5
    table[2][ORDER_FIELDS.index("category")] = None
    write_xlsx(tmp_path / "customer_orders.xlsx", table)
    write_docx(
        tmp_path / "customer_orders.docx",
        ["Customer Orders"],
        [ORDER_FIELDS] + [[order(n)[f] for f in ORDER_FIELDS] for n in (41, 42)],
    )
    (tmp_path / "notes.md").write_text("not a landing file")
    return str(tmp_path)


def test_all_formats_reach_bronze(spark, landing):
    at = datetime(2026, 1, 1, 2, 0)
    loaded = bronze.customer_orders(spark, landing, at)
    assert loaded.columns == ["bronze_id", "source_file", "source_row", "extracted_at", "raw_json", *ORDER_FIELDS]
    assert all(kind == "string" for name, kind in loaded.dtypes if name in ORDER_FIELDS)
    rows = {row.order_id: row for row in loaded.collect()}
    assert len(rows) == 13
    assert [rows[f"ORD{n:08d}"].bronze_id for n in (1, 2, 3, 4, 41, 42, 11, 12, 21, 22, 23, 31, 32)] == list(range(1, 14))
    assert [rows[f"ORD{n:08d}"].source_row for n in (1, 4, 41, 42, 11, 12, 21, 23, 32)] == [1, 4, 1, 2, 1, 2, 1, 3, 2]
    assert {row.extracted_at for row in rows.values()} == {at}

    assert rows["ORD00000002"].customer_name == 'Doe, "Jane"'
    assert rows["ORD00000003"].province == "two\nlines"
    assert rows["ORD00000004"].category == ""
    assert rows["ORD00000011"].quantity == "3" and rows["ORD00000011"].unit_price == "48.0"
    assert json.loads(rows["ORD00000012"].raw_json)["extra"] == "kept"
    assert rows["ORD00000022"].province is None
    assert "สมชาย" in rows["ORD00000021"].raw_json and "สมชาย" in rows["ORD00000001"].raw_json
    assert rows["ORD00000031"].order_date == "2026-03-09"
    assert rows["ORD00000032"].order_date == "2026-03-10"
    assert rows["ORD00000032"].quantity == "5" and rows["ORD00000032"].category is None
    assert rows["ORD00000041"].customer_name == "สมชาย ใจดี"
    assert rows["ORD00000041"].source_file == "customer_orders.docx"


def test_full_reload_replaces(spark, landing, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("lake") / "bronze")
    first = bronze.load(spark, landing, out).count()
    assert bronze.load(spark, landing, out).count() == first == 13


def test_shards_count_as_one_file(spark, tmp_path):
    rows = [{name: str(i) for name in ORDER_FIELDS} for i in range(1, 301)]
    spark.createDataFrame(rows).repartitionByRange(6, F.col("order_id").cast("int")).write.json(
        str(tmp_path / "customer_orders.txt")
    )
    loaded = bronze.customer_orders(spark, str(tmp_path)).collect()
    assert {row.source_file for row in loaded} == {"customer_orders.txt"}
    assert all(row.bronze_id == row.source_row == int(row.order_id) for row in loaded) and len(loaded) == 300


def test_medallion(spark, landing, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("medallion"))
    counts = {row.table_name: row.rows for row in medallion.run(spark, landing, out).collect()}
    assert counts["bronze_customer_orders"] == counts["silver_customer_orders"] == counts["fact_sales"] == 13
    fact = spark.read.parquet(f"{out}/gold/fact_sales")
    assert sorted(row.sale_key for row in fact.select("sale_key").collect()) == list(range(1, 14))
    assert {row.month for row in fact.select("month").collect()} == {202603, None}
    assert counts["silver_rejects"] > 0 and counts["repeated_keys"] == 0


def test_no_supported_file_fails(spark, tmp_path):
    (tmp_path / "readme.md").write_text("x")
    with pytest.raises(FileNotFoundError):
        files.landing_records(spark, str(tmp_path), ("customer_orders.csv",), ORDER_FIELDS)


def test_broken_json_line_fails(spark, tmp_path):
    (tmp_path / "customer_orders.txt").write_text('{"order_id": "1"}\n{"order_id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.jsonl_records(spark, str(tmp_path / "customer_orders.txt"), ORDER_FIELDS).collect()


def test_plain_csv_is_split_over_tasks(spark, tmp_path):
    rows = "".join(f"ORD{i},2026-01-01,C{i},{'x' * 60}\n" for i in range(20_000))
    (tmp_path / "customer_orders.csv").write_text("order_id,order_date,customer_id,customer_name\n" + rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
        whole = files.landing_records(spark, str(tmp_path), ("customer_orders.csv",), ORDER_FIELDS)
        plain = files.landing_records(spark, str(tmp_path), ("customer_orders.csv",), ORDER_FIELDS, quoted_newlines=False)
        assert whole.rdd.getNumPartitions() == 1 and plain.rdd.getNumPartitions() > 5
        one = bronze.customer_orders(spark, str(tmp_path), datetime(2026, 1, 1))
        many = bronze.customer_orders(spark, str(tmp_path), datetime(2026, 1, 1), quoted_newlines=False)
        assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty() and many.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_grain_keeps_two_lines_of_one_product(spark):
    from granary.plans import silver

    rows = [(1, "a.csv", "A", "P1"), (2, "a.csv", "A", "P1"), (3, "a.csv", "B", "P1"), (4, "b.csv", "A", "P1")]
    schema = "bronze_id bigint, source_file string, order_id string, product_id string"
    missing = {name: F.lit(None).cast("string") for name in ORDER_FIELDS if name not in ("order_id", "product_id")}
    frame = spark.createDataFrame(rows, schema).withColumns(missing)
    kept = silver.build(frame, silver.LINE_GRAIN).select("order_id", "line_number", "source_file").collect()
    assert sorted(map(tuple, kept)) == [("A", 1, "a.csv"), ("A", 2, "a.csv"), ("B", 1, "a.csv")]
    assert silver.build(frame).count() == 2


def test_positions_over_many_splits(spark, tmp_path):
    """Three files cut into many splits still count from 1 without gaps."""
    for part in range(3):
        body = "\n".join(f"{part}|{i}|{'x' * (i % 50)}" for i in range(1, 4001))
        (tmp_path / f"part{part}.txt").write_text(f"OrderID|ProductID|Note\n{body}\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        records = files.csv_records(spark, str(tmp_path), ["OrderID", "ProductID"], "|", quoted_newlines=False)
        assert records.select("_file", "_block").distinct().count() > 12
        rows = file_positions(records).select("bronze_id", "source_row", "OrderID", "ProductID").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 12000
    for row in rows:
        assert row.source_row == int(row.ProductID)
        assert row.bronze_id == int(row.OrderID) * 4000 + int(row.ProductID)


def test_paragraph_pattern(spark, tmp_path):
    write_docx(tmp_path / "policy.docx", ["Shippers", "  SHIP_ID: 3 ->  Flash Express  ", "SHIP_ID: x -> no",
                                          "see SHIP_ID:12->DHL"], [["SHIP_ID: 9 -> in a table"]])
    found = office.keyed_paragraphs(
        office.paragraphs(spark, str(tmp_path / "policy.docx")), r"SHIP_ID:\s*(\d+)\s*->\s*(.+)", ["id", "name"],
        marker="SHIP_ID:",
    )
    assert {(row.id, row.name) for row in found.collect()} == {("3", "Flash Express"), ("12", "DHL")}


def test_first_table_only(spark, tmp_path):
    path = tmp_path / "two.docx"
    write_docx(path, [], [["a", "b"], ["1", "2"]])
    rows = office.table_rows(spark, str(path)).collect()
    assert [json.loads(row.raw_json) for row in rows] == [{"a": "1", "b": "2"}]


def test_required_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    assert [row.name for row in files.missing_files(spark, str(tmp_path), ("a.csv", "b.csv")).collect()] == ["b.csv"]


def test_operational_snapshot(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "storefront_order"))
    frame = tables.snapshot(spark, str(tmp_path), "storefront_order")
    at = datetime(2026, 1, 1)
    tagged = bronze.with_lineage(frame, "storefront_order", at)
    assert tagged.select("_source", "_extract_ts").distinct().collect() == [("storefront_order", at)]


def test_conform(spark):
    frame = spark.createDataFrame([(1, "x")], "order_id int, other string")
    assert bronze.conform(frame, ["order_id", "province"]).collect() == [("1", None)]


def test_jsonl_export_round_trip(spark, tmp_path):
    from granary.plans.publish import export

    frame = spark.createDataFrame([("a", None), ("ข้าว", 2)], "name string, n int")
    export(frame, str(tmp_path / "out"), "json")
    assert sorted(spark.read.schema(frame.schema).json(str(tmp_path / "out")).collect()) == sorted(frame.collect())
    export(frame, str(tmp_path / "csv"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    with pytest.raises(ValueError):
        export(frame, str(tmp_path / "xml"), "xml")


def test_positions_are_plain_counts(spark, tmp_path):
    path = tmp_path / "rows.txt"
    path.write_text("\n".join(json.dumps({"order_id": str(i)}) + "\n" for i in range(1, 21)))
    rows = file_positions(files.jsonl_records(spark, str(path), ["order_id"])).orderBy("bronze_id").collect()
    assert [int(r.order_id) for r in rows] == [r.source_row for r in rows] == list(range(1, 21))


def test_all_operational_tables_are_snapshotted(spark, tmp_path):
    for number, source in enumerate(OPERATIONAL_TABLES.values(), start=1):
        spark.range(number).write.parquet(str(tmp_path / source))
    taken = bronze.operational_snapshots(spark, str(tmp_path), datetime(2026, 1, 1))
    assert {name: frame.count() for name, frame in taken.items()} == {
        f"bronze_{name}": number for number, name in enumerate(OPERATIONAL_TABLES, start=1)
    }
