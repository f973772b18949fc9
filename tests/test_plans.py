"""Shapes of the physical plans, and pricing, stock and generator edges."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from granary.catalog import QUERIES
from granary.contracts import coupon_table
from granary.operators.dedup import dedup_first
from granary.plans import generate, inventory, kpi, marketing, pricing, silver
from granary.sources import sample

SMALL = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_rows_before_the_shuffle(spark):
    text = plan(dedup_first(sample.table(spark, SMALL, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey"]))
    final, shuffle, partial = (text.index(part) for part in ("Final", "Exchange hashpartitioning", "Partial"))
    assert final < shuffle < partial


@pytest.mark.parametrize("name", ["surrogate_key", "fact_sales", "stock_running_balance", "loyalty_ranking"])
def test_no_row_passes_through_a_single_partition_window(spark, name):
    """Only the one-row-per-slice offsets may be gathered."""
    text = plan(QUERIES[name](spark, SMALL))
    for part in text.split("SinglePartition")[1:]:
        assert "HashAggregate" in part or "_rows" in part


def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["kpi_units"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text


def test_top_products_sums_before_the_dimension(spark):
    text = plan(QUERIES["top_products"](spark, SMALL))
    assert "TakeOrderedAndProject" in text and text.count("HashAggregate") >= 4


# -------------------------------------------------------------------- pricing
def basket(spark, *rows):
    return spark.createDataFrame(
        rows, "order_id bigint, subtotal decimal(18,2), order_date date, coupon_code string"
    )


def applied(spark, *rows, auto=True):
    frame = pricing.priced(basket(spark, *rows), coupon_table(spark), auto_apply=auto)
    return {r.order_id: (r.coupon, r.discount, r.final_price, r.total_with_shipping, r.points) for r in frame.collect()}


def test_coupon_limits(spark):
    d = Decimal
    result = applied(
        spark,
        (1, d("1000"), date(1995, 1, 1), None),       # at the minimum, on the first day
        (2, d("999.99"), date(1995, 1, 1), None),     # below the minimum
        (3, d("1000"), date(1999, 12, 31), None),     # on the last day
        (4, d("1000"), date(2000, 1, 1), None),       # after it
        (5, d("5000"), date(1998, 6, 1), None),       # 10 % and 500 are equal: lower code
        (6, d("20000"), date(1998, 6, 1), None),      # 20 % is best
        (7, d("20000"), date(1998, 6, 1), " pct10"),  # the named one, not the best
        (8, d("2000"), date(1998, 6, 1), "NOPE"),     # unknown code: no discount
        (9, d("2000"), date(1998, 6, 1), " "),        # blank code counts as none
    )
    assert result[1] == ("PCT10", d("100.00"), d("900.00"), d("950.00"), 9)
    assert result[2][0] is None and result[2][4] == 9
    assert result[3][0] == "PCT10" and result[4][0] is None
    assert result[5][:2] == ("FIX500", d("500.00"))
    assert result[6][:2] == ("PCT20", d("4000.00"))
    assert result[7][:2] == ("PCT10", d("2000.00"))
    assert result[8][:2] == (None, d("0.00")) and result[9][0] == "PCT10"


def test_only_named_coupons_unless_asked(spark):
    d = Decimal
    rows = [(1, d("2000"), date(1998, 6, 1), None), (2, d("2000"), date(1998, 6, 1), "pct10"), (3, d("9"), date(1998, 6, 1), "PCT10")]
    result = applied(spark, *rows, auto=False)
    assert [result[i][:2] for i in (1, 2, 3)] == [(None, d("0.00")), ("PCT10", d("200.00")), (None, d("0.00"))]


def test_ten_thousand_coupons_make_no_arrays(spark):
    """Many coupons, some without an end, against trying each."""
    import random

    draw = random.Random(4)
    rows = []
    for n in range(10_000):
        start = date(1998, 1, 1 + draw.randrange(28))
        end = date(1998, 2, 1 + draw.randrange(28)) if n % 50 else None
        kind = "percentage" if n % 2 else "fixed"
        value = Decimal(draw.randrange(1, 40)) if n % 2 else Decimal(draw.randrange(1, 90))
        rows.append((f"C{n:05d}", kind, value, Decimal(100 + draw.randrange(400)), n % 7 != 0, start if n % 11 else None, end))
    schema = "code string, discount_type string, value decimal(10,2), min_purchase decimal(10,2), active boolean, start_date date, end_date date"
    coupons = spark.createDataFrame(rows, schema)
    orders = [
        (i, Decimal(draw.randrange(9000, 60000)) / 100, date(1998, 1 + i % 3, 1 + i % 28), f"c{draw.randrange(10_000):05d} " if i % 3 == 0 else None)
        for i in range(150)
    ]
    frame = pricing.priced(basket(spark, *orders), coupons, auto_apply=True)
    assert "collect_list" not in plan(frame)
    got = {r.order_id: (r.coupon, r.discount) for r in frame.collect()}
    for number, subtotal, day, wanted in orders:
        tried = []
        for code, kind, value, least, active, start, end in rows:
            if active and (start is None or start <= day) and (end is None or day <= end) and subtotal >= least:
                if wanted is None or wanted.strip().upper() == code:
                    exact = min(subtotal * value / 100 if kind == "percentage" else value, subtotal)
                    tried.append((-exact, code))
        expected = (min(tried)[1], -min(tried)[0]) if tried else (None, Decimal(0))
        assert got[number][0] == expected[0], (number, got[number], expected)
        assert abs(got[number][1] - expected[1]) <= Decimal("0.005")


def test_coupon_windows_of_minutes(spark):
    """Each coupon tried on each basket, around the very ends of windows, open ones included."""
    import random
    from datetime import datetime, timedelta

    draw, base = random.Random(6), datetime(1998, 1, 1)
    minute = lambda most: base + timedelta(minutes=draw.randrange(most))
    rows = [("A", "percentage", Decimal(50), Decimal(0), True, datetime(1998, 1, 1, 9, 30), datetime(1998, 1, 31))]
    for n in range(400):
        start = minute(60_000) if n % 9 else None
        end = ((start or base) + timedelta(minutes=draw.choice([0, 1, 30, 5_000, 400_000]))) if n % 8 else None
        kind = ("percentage", "fixed")[n % 2]
        rows.append((f"C{n:03d}", kind, Decimal(draw.randrange(1, 40)), Decimal(draw.randrange(4) * 100), n % 7 != 0, start, end))
    schema = "code string, discount_type string, value decimal(10,2), min_purchase decimal(10,2), active boolean, start_date timestamp, end_date timestamp"
    times = [datetime(1998, 1, 1, 8), datetime(1998, 1, 31, 12)] + [minute(90_000) for _ in range(150)]
    times += [at + timedelta(microseconds=shift) for row in rows[::9] for at in row[5:] if at for shift in (-1, 0, 1)]
    orders = [(i, Decimal(draw.randrange(5000, 60000)) / 100, at, None) for i, at in enumerate(times)] + [(9999, Decimal(50), None, None)]
    baskets = spark.createDataFrame(orders, "order_id bigint, subtotal decimal(18,2), at timestamp, coupon_code string")
    frame = pricing.priced(baskets, spark.createDataFrame(rows, schema), at="at", auto_apply=True)
    got = {r.order_id: r.coupon for r in frame.collect()}
    assert len(got) == len(orders) and got[9999] is None
    for number, subtotal, at, _ in orders[:-1]:
        tried = [
            (-min(subtotal * value / 100 if kind == "percentage" else value, subtotal), code)
            for code, kind, value, least, active, start, end in rows
            if active and (start is None or start <= at) and (end is None or at <= end) and subtotal >= least
        ]
        assert got[number] == (min(tried)[1] if tried else None), (number, at)
    assert got[0] != "A" and got[1] != "A"


def test_a_long_window_is_few_pieces(spark):
    from granary.operators import intervals

    frame = spark.createDataFrame([(a, b) for a in range(40) for b in range(a + 1, 41)], "_from long, _to long").withColumn("w", F.struct("_from", "_to"))
    cut = intervals.pieces(frame, 7)
    assert cut.groupBy("w").count().agg(F.max("count")).first()[0] <= 12
    spread = intervals.ancestors(spark.range(41).withColumnRenamed("id", "n"), "n", 7)
    covered = spread.join(cut, ["_level", "_node"]).groupBy("w").agg(F.count("n").alias("c"), F.min("n").alias("a"), F.max("n").alias("b"))
    assert covered.where("c <> w._to - w._from or a <> w._from or b <> w._to - 1").count() == 0 and covered.count() == 820


def test_fixed_discount_stops_at_the_subtotal(spark):
    coupons = coupon_table(spark).withColumn("min_purchase", F.expr("0BD").cast("decimal(10,2)"))
    frame = pricing.priced(basket(spark, (1, Decimal("120"), date(2000, 6, 1), "fix500")), coupons)
    row = frame.first()
    assert (row.discount, row.final_price, row.points) == (Decimal("120.00"), Decimal("0.00"), 0)
    assert row.total_with_shipping == Decimal("50.00")


def test_no_coupons_at_all(spark):
    frame = pricing.priced(basket(spark, (1, Decimal("5000"), date(1998, 6, 1), None)), coupon_table(spark).limit(0))
    assert frame.first().final_price == Decimal("5000.00")


def test_loyalty_balances_create_accounts(spark):
    opening = spark.createDataFrame([("1", 5)], "phone string, points bigint")
    earned = spark.createDataFrame([("1", 3), ("2", 4)], "phone string, points bigint")
    assert sorted(marketing.loyalty_balances(opening, earned).collect()) == [("1", 8), ("2", 4)]


# ---------------------------------------------------------------------- stock
def test_oversell(spark):
    rows = [(1, 10, date(2026, 1, 1), 3), (2, 10, date(2026, 1, 1), 3), (3, 10, date(2026, 1, 2), 1),
            (4, 10, date(2026, 1, 2), 5), (5, 11, date(2026, 1, 1), 2)]
    demand = spark.createDataFrame(rows, "order_id bigint, product_id bigint, order_date date, quantity bigint")
    stock = spark.createDataFrame([(10, 7), (11, 2)], "product_id bigint, stock bigint")
    report = inventory.oversell_report(demand, stock, ["order_id"])
    assert report.collect() == [(10, 7, 4, 12)]


def test_snapshot_fills_gaps(spark):
    rows = [(1, 5, "2026-01-01 10:00:00", "inbound", 10), (2, 5, "2026-01-04 10:00:00", "outbound", -9)]
    log = spark.createDataFrame(rows, "log_id bigint, product_id bigint, created_at string, log_type string, change_quantity bigint")
    log = log.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    points = spark.createDataFrame([(5, 1)], "product_id bigint, reorder_point bigint")
    snapshot = inventory.stock_snapshot(log, points).orderBy("snapshot_date_key").collect()
    assert [(r.snapshot_date_key, r.current_quantity, r.is_low_stock) for r in snapshot] == [
        (20260101, 10, False), (20260102, 10, False), (20260103, 10, False), (20260104, 1, True)]
    supply = {r.snapshot_date_key: r.days_of_supply for r in inventory.days_of_supply(log).collect()}
    assert supply == {20260101: None, 20260104: Decimal("3.3333")}


# ----------------------------------------------------------------------- kpis
def test_chart_ties_and_limit(spark):
    sales = spark.createDataFrame(
        [(1, "b", Decimal("5"), 1), (2, "a", Decimal("5"), 1), (2, "c", Decimal("1"), 2)],
        "order_id bigint, name string, net_revenue decimal(18,2), quantity bigint",
    )
    assert [r.name for r in kpi.chart(sales, "revenue", ("name",), limit=2).collect()] == ["a", "b"]
    assert kpi.orders_with_sales(sales).first()[0] == 2
    assert kpi.units_sold(sales).first()[0] == 4


def test_charts_are_whole_without_a_limit(spark):
    days = spark.range(12_000).selectExpr(
        "id as order_id", "date_add(date'1990-01-01', cast(id as int)) as order_date",
        "cast(1 as decimal(18,2)) as net_revenue",
    )
    assert kpi.daily_revenue(days).count() == 12_000
    assert kpi.chart(days, "revenue", grain="day", limit=kpi.CHART_ROW_LIMIT).count() == kpi.CHART_ROW_LIMIT


def test_view_neither_numbers_nor_stages(spark):
    text = plan(QUERIES["sales_dashboard"](spark, SMALL))
    assert "rangepartitioning" not in text and "/lineitem.parquet" in text


def test_silver_keeps_unreadable_rows_with_nulls(spark):
    from granary.contracts import ORDER_FIELDS

    good = {name: "1" for name in ORDER_FIELDS}
    rows = [
        (1, "a.csv", "t", *({**good, "order_id": "A", "order_date": "2026-01-01"}).values()),
        (2, "a.csv", "t", *({**good, "order_id": "A"}).values()),
        (3, "a.csv", "t", *({**good, "order_id": "B", "quantity": "abc", "order_date": "x"}).values()),
        (4, "a.csv", "t", *({**good, "order_id": "  "}).values()),
        (5, "a.csv", "t", *({**good, "order_id": None}).values()),
    ]
    schema = "bronze_id bigint, source_file string, extracted_at string, " + ", ".join(f"{n} string" for n in ORDER_FIELDS)
    bronze = spark.createDataFrame(rows, schema)
    built = {r.order_id: r for r in silver.build(bronze).collect()}
    assert set(built) == {"A", "B"}
    assert built["A"].order_date == date(2026, 1, 1) and built["B"].quantity is None
    rejects = {(r.bronze_id, r.field) for r in silver.cast_rejects(bronze).collect()}
    assert {(3, "quantity"), (3, "order_date")} <= rejects


# ------------------------------------------------------------------ generator
def test_generated_orders_follow_the_weights(spark):
    products = sample.products(spark, SMALL)
    made = generate.orders(spark.range(20000), products, seed=5).toPandas()
    assert len(made) == 20000
    status = made["status"].value_counts(normalize=True)
    assert abs(status["paid"] - 0.8) < 0.02 and abs(status["shipped"] - 0.08) < 0.01
    assert abs(made["items"].mean() - 2.5) < 0.05
    assert set(made["payment_method"]) == {"promptpay", "credit", "cod"}
    assert (made["final_price"] == made["total_price"] - made["discount_applied"]).all()
    assert (made.loc[made["total_price"] < 1000, "discount_applied"] == 0).all()


def test_generator_does_not_depend_on_partitions(spark):
    products = sample.products(spark, SMALL)
    one = generate.orders(spark.range(0, 500, numPartitions=1), products, 3)
    many = generate.orders(spark.range(0, 500, numPartitions=16), products, 3)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_generated_orders_hold_each_product_once(spark):
    for size in (3, 4, 11):
        products = spark.range(size).selectExpr("id as product_id", "cast(1 as decimal(18,2)) as unit_price")
        items = generate.order_items(spark.range(300), products, 9)
        assert items.groupBy("order_id", "product_id").count().filter("count > 1").isEmpty()


def test_generated_lines(spark):
    products = spark.range(10).selectExpr(
        "id as product_id", "concat('p', id) as product_name", "'c' as category",
        "cast(id * 7.35 as decimal(18,2)) as unit_price",
    )
    made = generate.order_lines(spark.range(1, 3001), products, 1, "2026-09-22").toPandas()
    assert len(made) == 3000 and set(made["discount_pct"]) == {0, 5, 10, 15}
    assert abs((made["discount_pct"] == 0).mean() - 0.5) < 0.04
    assert made["order_date"].min() >= date(2025, 9, 21) and made["order_date"].max() <= date(2026, 9, 22)
    assert made["order_id"].is_unique and made["quantity"].between(1, 5).all()


def test_long_keys_stay_whole(spark):
    products = spark.createDataFrame([(1, "p", "c", 1)], "product_id bigint, product_name string, category string, unit_price int")
    ids = spark.createDataFrame([(7,), (99_999_999,), (100_000_000,), (100_000_001,), (1_000_000_000,)], "id bigint")
    provinces = spark.createDataFrame([("north",), ("south",)], "province string")
    made = generate.order_lines(ids, products, 1, "2026-09-22", provinces).collect()
    assert {r.order_id for r in made} == {"ORD00000007", "ORD99999999", "ORD100000000", "ORD100000001", "ORD1000000000"}
    assert len({r.customer_id for r in made}) == 5 and {r.province for r in made} <= {"north", "south"}
    assert generate.order_lines(ids, products, 1, "2026-09-22").first().province is None


def test_long_keys_stay_whole_in_order_files(spark, tmp_path):
    """Orders, customers and products whose numbers have nine and more digits."""
    for name in ("orders", "lineitem", "customer", "part", "nation"):
        sample.table(spark, SMALL, name).limit(0 if name != "nation" else 1).write.parquet(str(tmp_path / f"{name}.parquet"))

    def add(name, row):
        spark.createDataFrame([row], sample.table(spark, SMALL, name).schema).write.mode("append").parquet(
            str(tmp_path / f"{name}.parquet")
        )

    from datetime import datetime

    nation = sample.table(spark, SMALL, "nation").first().n_nationkey
    for big in (10_000_000, 100_000_000, 100_000_001):
        add("orders", (big, big, "F", 1.0, datetime(1996, 1, 1), "1-URGENT"))
        add("customer", (big, "c", nation, 0.0, "x"))
        add("part", (big, "p", "b", "t", 1, 1.0))
        add("lineitem", (big, big, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", datetime(1996, 1, 2)))
    rows = sample.customer_orders(spark, str(tmp_path)).collect()
    ids = {"10000000", "100000000", "100000001"}
    assert {r.customer_id for r in rows} == {f"CUS{i}" for i in ids}
    assert {r.product_id for r in rows if r.order_id.strip()} <= {f"P{i}" for i in ids}
    assert {r.order_id for r in rows} - {"  "} == {f"ORD{i}" for i in ids if int(i) % 11}


def test_generated_shipments(spark):
    made = generate.orders(spark.range(5000), sample.products(spark, SMALL), 2)
    parcels = generate.shipments(made, 2)
    shipped = made.filter("status in ('paid', 'shipped')").count()
    assert parcels.count() == shipped and abs(shipped / 5000 - 0.88) < 0.02
    assert parcels.filter("length(tracking_number) <> 16 or carrier is null").isEmpty()


def test_first_lines_are_chosen_among_lines_that_meet_the_other_tables(spark, tmp_path):
    for name in ("nation", "customer", "part", "orders", "lineitem"):
        rows = sample.table(spark, SMALL, name)
        if name == "part":
            rows = rows.where("p_partkey % 3 <> 0")
        if name in ("customer", "nation", "orders"):
            rows = rows.where(f"{rows.columns[0]} % 7 <> 0")
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    whole = QUERIES["silver_build"](spark, str(tmp_path))
    short = QUERIES["silver_customer_orders"](spark, str(tmp_path))
    rows = sorted(map(str, whole.collect()))
    assert rows and sorted(map(str, short.collect())) == rows
