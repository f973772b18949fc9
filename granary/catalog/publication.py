"""Publication by several writers, keys that stay, and tables kept up by what changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.catalog.registry import query
from granary.functions import numbers
from granary.operators import bitmaps, digest_tree
from granary.plans import commits, gold, registry, upkeep
from granary.session import scratch_path, stage
from granary.sources import sample


# ------------------------------------------------------------------- commits
@query(
    "published_versions",
    """SELECT 1 AS version, 'orders' AS table_name, count(*) FILTER (order_id % 3 = 0) AS rows FROM heads
       UNION ALL SELECT 2, 'orders', count(*) FROM heads
       UNION ALL SELECT 3, 'orders', count(*) FROM heads
       UNION ALL SELECT 3, 'customers', count(*) FROM people""",
)
def published_versions(spark, folder):
    """Rows of each table in each version; the third writer started from the first version and had to try again."""
    root = scratch_path(spark, "published")

    def written(df: DataFrame, name: str) -> str:
        df.write.parquet(f"{root}/{name}")
        return f"{root}/{name}"

    orders = sample.orders(spark, folder)
    part = written(orders.where("order_id % 3 = 0"), "orders-part")
    first = commits.commit(spark, root, commits.EMPTY, "part", {"orders": part})
    commits.commit(spark, root, first, "all", {"orders": written(orders, "orders-all")})
    customers = {"customers": written(sample.customers(spark, folder), "customers")}
    try:
        commits.commit(spark, root, first, "customers", customers)
    except commits.Conflict:
        commits.publish(spark, root, "customers", lambda parent: (customers, {}))
    counted = [
        commits.table(spark, root, name, number).agg(F.count("*").alias("rows")).select(
            F.lit(number).alias("version"), F.lit(name).alias("table_name"), "rows"
        )
        for number in commits.versions(spark, root)
        for name in commits.at(spark, root, number).tables
    ]
    return reduce(DataFrame.unionByName, counted)


# ---------------------------------------------------------------------- keys
@query(
    "dim_customer_registry",
    """SELECT customer_id, company_name, city,
              row_number() OVER (ORDER BY CASE customer_id % 3 WHEN 1 THEN 1 ELSE 2 END, customer_id) AS customer_key
       FROM people""",
)
def dim_customer_registry(spark, folder):
    """Customers keyed over two loads, the second one repeated: the first load's keys stay."""
    root, people = scratch_path(spark, "customer-keys"), sample.customers(spark, folder)
    registry.assign(spark, root, "customer", people.where("customer_id % 3 = 1"), "customer_id", "customer_key", "first")
    registry.assign(spark, root, "customer", people, "customer_id", "customer_key", "second")
    return registry.keyed(spark, root, "customer", people, "customer_id", "customer_key", "second")


# -------------------------------------------------------------------- upkeep
LINES = upkeep.Kept("lines", ("order_id", "product_id", "unit_price", "quantity", "discount"), by=("order_id",), buckets=8, whole=True)
HEADS = upkeep.Kept("heads", ("order_id", "customer_id", "order_date", "shipper_id"), by=("order_id",), buckets=8, whole=True)


def _kept_up(spark, folder, kept: upkeep.Kept) -> DataFrame:
    """A table of the sales after four loads: most rows, new ones, changed ones, and some that go."""
    root = scratch_path(spark, f"upkeep-{kept.name}")
    lines, heads = sample.order_details(spark, folder), sample.orders(spark, folder).select(*HEADS.keys)
    late, moved, extra = "order_id % 10 = 0", "order_id % 7 = 3", "order_id % 9 = 4"
    wrong = heads.where(moved).withColumns(
        {"shipper_id": F.lit(0).cast("long"), "order_date": F.date_add("order_date", 400), "customer_id": F.lit(-1).cast("long")}
    )
    doubtful = lines.where(extra).withColumns(
        {"unit_price": (F.col("unit_price") * 3).cast("decimal(18,2)"), "product_id": F.when(F.col("product_id") % 5 == 0, -1).otherwise(F.col("product_id"))}
    )
    none_l, none_h = upkeep.changes(lines.limit(0)), upkeep.changes(heads.limit(0))
    first_heads = heads.where(f"not ({late}) and not ({moved})").unionByName(wrong.where(f"not ({late})"))
    revenue = {"net_revenue": numbers.net_revenue("quantity", "unit_price", "discount")}
    by_line = bool(set(kept.grain) & set(LINES.grain))  # else the lines of an order are added up before they meet its head
    loads = {
        "most": (upkeep.changes(lines.where(f"not ({late})").unionByName(doubtful)), upkeep.changes(first_heads)),
        "new": (upkeep.changes(lines.where(late)), upkeep.changes(heads.where(f"({late}) and not ({moved})").unionByName(wrong.where(late)))),
        "changed": (none_l, upkeep.changes(heads.where(moved), wrong)),
        "gone": (upkeep.changes(lines.limit(0), doubtful), none_h),
    }
    for load, (line_changes, head_changes) in loads.items():

        def build(state):
            parts = upkeep.parts(spark, root, load, [(LINES, line_changes), (HEADS, head_changes)])
            changed_l, changed_h = (part.changes() for part in parts)
            before_l = upkeep.rows(spark, state, LINES, changed_h, lines.schema)
            before_h = upkeep.rows(spark, state, HEADS, changed_l, heads.schema)
            sales = upkeep.joined(before_l, changed_l, before_h, changed_h, "order_id", None if by_line else revenue)
            return [*parts, (kept, sales.withColumns(revenue) if by_line else sales)]

        upkeep.apply(spark, root, load, build)
        upkeep.apply(spark, root, load, build)  # a load that is repeated changes nothing
    return upkeep.result(spark, root, kept)


@query(
    "upkeep_daily_revenue",
    """SELECT order_date, count(*) AS rows, CAST(sum(net_revenue) AS DECIMAL(18,2)) AS revenue
       FROM sales GROUP BY order_date""",
)
def upkeep_daily_revenue(spark, folder):
    days = _kept_up(spark, folder, upkeep.Kept("daily_revenue", ("order_date",), ("net_revenue",), buckets=8))
    return days.select("order_date", "rows", F.col("net_revenue").cast("decimal(18,2)").alias("revenue"))


@query(
    "upkeep_dim_product",
    """SELECT product_id AS product_key, max(unit_price) AS current_price, CAST(sum(quantity) AS BIGINT) AS units
       FROM sales GROUP BY product_id""",
)
def upkeep_dim_product(spark, folder):
    """Greatest price and units per product; the greatest prices of the first loads go with the last."""
    kept = upkeep.Kept("dim_product", ("product_id",), ("quantity",), "unit_price", buckets=8)
    return _kept_up(spark, folder, kept).select(
        F.col("product_id").alias("product_key"), F.col("unit_price").alias("current_price"), F.col("quantity").alias("units")
    )


@query(
    "upkeep_revenue_by_shipper",
    """SELECT shipper_id, customer_id, count(*) AS total_lines, CAST(sum(net_revenue) AS DECIMAL(18,2)) AS total_spent
       FROM sales GROUP BY ALL""",
)
def upkeep_revenue_by_shipper(spark, folder):
    """Spending per shipper and customer; the groups of changed orders vanish."""
    kept = upkeep.Kept("by_shipper", ("shipper_id", "customer_id"), ("net_revenue",), buckets=8)
    return _kept_up(spark, folder, kept).select(
        "shipper_id", "customer_id", F.col("rows").alias("total_lines"), F.col("net_revenue").cast("decimal(18,2)").alias("total_spent")
    )


# ---------------------------------------------------- roll-ups and comparison
@query(
    "orders_rollup",
    """SELECT 'day' AS grain, strftime(order_date, '%Y-%m-%d') AS label, count(DISTINCT order_id) AS orders FROM sales GROUP BY ALL
       UNION ALL SELECT 'month', strftime(order_date, '%Y-%m'), count(DISTINCT order_id) FROM sales GROUP BY ALL
       UNION ALL SELECT 'shipper', CAST(shipper_id AS VARCHAR), count(DISTINCT order_id) FROM sales GROUP BY ALL
       UNION ALL SELECT 'all', 'all', count(DISTINCT order_id) FROM sales""",
)
def orders_rollup(spark, folder):
    """Orders with sales at four grains, all from one roll-up of bitmaps by day and shipper."""
    sales = gold.fact_sales(sample.order_details(spark, folder), sample.orders(spark, folder))
    rolled = stage(bitmaps.rollup(sales, "order_id", ["order_date", "shipper_id"]), "orders-rollup")
    grains = {
        "day": F.date_format("order_date", "yyyy-MM-dd"), "month": F.date_format("order_date", "yyyy-MM"),
        "shipper": F.col("shipper_id").cast("string"), "all": F.lit("all"),
    }
    parts = [
        bitmaps.distinct_count(rolled, [F.lit(grain).alias("grain"), label.alias("label")], "orders")
        for grain, label in grains.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "differing_orders",
    """SELECT order_id, CASE WHEN order_id % 997 = 5 THEN 'missing' ELSE 'changed' END AS state
       FROM heads WHERE order_id % 997 IN (5, 6)
       UNION ALL SELECT -order_id, 'new' FROM heads WHERE order_id % 997 = 7""",
)
def differing_orders(spark, folder):
    """Orders of a copy that lack, changed or came, named from digests without joining what agrees."""
    root, heads = scratch_path(spark, "digests"), sample.orders(spark, folder)
    rest = F.col("order_id") % 997
    copy = heads.where(rest != 5).withColumn("freight", F.when(rest == 6, F.col("freight") + 1).otherwise(F.col("freight")).cast("decimal(18,2)"))
    copy = stage(copy.unionByName(heads.where(rest == 7).withColumn("order_id", -F.col("order_id"))), "orders-copy")
    for name, table in (("left", heads), ("right", copy)):
        digest_tree.write_tree(table, ["order_id"], f"{root}/{name}")
    return digest_tree.differences(heads, copy, ["order_id"], f"{root}/left", f"{root}/right")
