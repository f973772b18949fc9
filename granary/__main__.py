"""Command line: ``python -m granary <job> ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import functions as F

from granary import session
from granary.contracts import LANDING_FILES
from granary.plans import generate, medallion, northwind, publish, silver


def _catalogue(spark, location: str):
    """Products to draw from: a Parquet table with the operational columns."""
    products = spark.read.parquet(location)
    category = F.col("category") if "category" in products.columns else F.lit(None).cast("string")
    return products.select(
        F.col("id").cast("bigint").alias("product_id"),
        F.col("name").alias("product_name"),
        category.alias("category"),
        F.col("price").cast("decimal(18,2)").alias("unit_price"),
    )


def main() -> None:
    parser = argparse.ArgumentParser(prog="granary", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    orders = jobs.add_parser("medallion", help="order files to Bronze, Silver and Gold")
    orders.add_argument("--input-dir", required=True, help=f"folder with any of {', '.join(LANDING_FILES)}")
    orders.add_argument("--out", required=True)
    orders.add_argument("--line-grain", action="store_true", help="keep every line of an order")
    orders.add_argument(
        "--plain-csv", action="store_true", help="no line breaks inside CSV quotes: large files are split over tasks"
    )

    lake = jobs.add_parser("northwind", help="validate and publish the Northwind files")
    lake.add_argument("--input-dir", required=True)
    lake.add_argument("--out", required=True)
    lake.add_argument("--validate-only", action="store_true")

    lines = jobs.add_parser("generate-lines", help="sample landing file (JSON Lines)")
    lines.add_argument("--records", type=int, default=10_000)
    lines.add_argument("--seed", type=int, default=20260922)
    lines.add_argument("--provinces", help="Parquet with a column province to draw from")

    sale = jobs.add_parser("generate-orders", help="sample priced orders (Parquet)")
    sale.add_argument("--total", type=int, default=5_000_000)
    sale.add_argument("--seed", type=int, default=1)
    sale.add_argument("--completed-ratio", type=float, default=0.8)
    for job in (lines, sale):
        job.add_argument("--products", required=True, help="Parquet with id, name, price and optionally category")
        job.add_argument("--out", required=True)

    args = parser.parse_args()
    spark = session.build()
    try:
        run(spark, args)
    finally:
        session.drop_staged(spark)


def run(spark, args: argparse.Namespace) -> None:
    if args.job == "medallion":
        keys = silver.LINE_GRAIN if args.line_grain else ("order_id",)
        medallion.run(spark, args.input_dir, args.out, keys, not args.plain_csv).show(truncate=False)
    elif args.job == "northwind":
        result = northwind.run(spark, args.input_dir, args.out, args.validate_only)
        result.summary.show(truncate=False)
    elif args.job == "generate-lines":
        ids = spark.range(1, args.records + 1)
        provinces = spark.read.parquet(args.provinces).select("province") if args.provinces else None
        rows = generate.order_lines(
            ids, _catalogue(spark, args.products), args.seed, date.today().isoformat(), provinces
        )
        publish.export(rows, f"{args.out}/customer_orders.txt", "json")
    else:
        ids = spark.range(1, args.total + 1)
        catalogue = _catalogue(spark, args.products)
        items = publish.rebuild(generate.order_items(ids, catalogue, args.seed), f"{args.out}/order_items")
        made = generate.orders(ids, catalogue, args.seed, args.completed_ratio, items)
        made.write.mode("overwrite").parquet(f"{args.out}/orders")
        generate.shipments(spark.read.parquet(f"{args.out}/orders"), args.seed).write.mode("overwrite").parquet(
            f"{args.out}/shipments"
        )


if __name__ == "__main__":
    main()
