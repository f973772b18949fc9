"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder with the sample tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_QUERIES comma-separated names, or "all"
BENCH_ORDERS  instead, generate that many order lines and run the medallion
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from granary import session  # noqa: E402
from granary.catalog import QUERIES  # noqa: E402
from granary.plans import generate, medallion, publish  # noqa: E402
from granary.sources import sample  # noqa: E402

HEADLINE = [
    "kpi_net_revenue", "kpi_orders", "kpi_units", "daily_revenue", "revenue_by_shipper", "top_products",
    "sales_dashboard", "fact_sales", "silver_customer_orders", "dedup_first_line", "fact_sales_local",
    "dim_customer", "surrogate_key", "dq_orphans", "dq_conflicting_duplicates", "recon_revenue", "priced_orders",
    "dim_customer_tiered", "stock_running_balance", "fact_stock_snapshot", "oversell_report", "order_detail",
    "content_fingerprint", "payload_validate", "gen_orders", "stream_stock_level",
]


def medallion_run(spark, folder: str, orders: int) -> dict[str, float]:
    """Seconds to generate landing lines and to take them to Gold."""
    products = sample.table(spark, folder, "part").selectExpr(
        "p_partkey as product_id", "p_name as product_name", "p_type as category",
        "cast(p_retailprice as decimal(18,2)) as unit_price",
    )
    root = session.scratch_path(spark, "medallion-bench")
    started = time.perf_counter()
    lines = generate.order_lines(spark.range(1, orders + 1), products, 20260922, "2026-09-22")
    publish.export(lines, f"{root}/landing/customer_orders.txt", "json")
    generated = time.perf_counter()
    medallion.run(spark, f"{root}/landing", f"{root}/lake").collect()
    return {"generate": round(generated - started, 3), "medallion": round(time.perf_counter() - generated, 3)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = session.build(
        "granary-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("BENCH_ORDERS"):
        orders = int(os.environ["BENCH_ORDERS"])
        seconds = medallion_run(spark, folder, orders)
        total = round(sum(seconds.values()), 3)
        print(json.dumps({"metric": f"medallion_{orders}_orders", "value": total, "unit": "sec", "queries": seconds}))
        spark.stop()
        return
    # start the JVM's code paths before the clock runs
    QUERIES["kpi_units"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
