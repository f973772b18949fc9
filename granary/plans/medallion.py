"""Order files through Bronze and Silver to the Gold star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from granary.operators.quality import duplicate_keys
from granary.plans import bronze, gold, publish, silver


def run(
    spark: SparkSession, landing: str, out: str, keys: tuple[str, ...] = ("order_id",), quoted_newlines: bool = True
) -> DataFrame:
    """Rebuild all layers under ``out`` and return the row count of each table.

    Every layer reads the stored layer below it, so a lost executor repeats
    work of one layer at most. Values that did not convert and repeated
    customer and product keys are written as reports beside the tables.
    """
    raw = bronze.load(spark, landing, f"{out}/bronze/customer_orders", quoted_newlines)
    built = publish.rebuild(silver.build(raw, keys), f"{out}/silver/customer_orders")
    rejects = publish.rebuild(silver.cast_rejects(silver.with_key(raw)), f"{out}/silver/rejects")

    layers = {"bronze_customer_orders": raw, "silver_customer_orders": built, "silver_rejects": rejects}
    for name, table in gold.build(built).items():
        path = f"{out}/gold/{name}"
        if name == "fact_sales":
            layers[name] = publish.rebuild(publish.by_month(table, "date_key", ["product_key"]), path, ["month"])
        else:
            layers[name] = publish.rebuild(table, path)
    repeated = duplicate_keys(layers["dim_customer"], "dim_customer", "customer_key").unionByName(
        duplicate_keys(layers["dim_product"], "dim_product", "product_key")
    )
    layers["repeated_keys"] = publish.rebuild(repeated, f"{out}/gold/repeated_keys")
    return publish.row_counts(layers)
