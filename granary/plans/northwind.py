"""Northwind lakehouse: five files to a validated, published sales view."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.contracts import NORTHWIND_FILES, NORTHWIND_KEYS, NORTHWIND_TYPES
from granary.functions import numbers, text
from granary.operators import quality
from granary.operators.dedup import dedup_exact_or_reject
from granary.operators.fingerprint import batch_id
from granary.operators.keys import file_positions
from granary.plans import gold, publish
from granary.session import stage
from granary.sources import files, office

MODEL_VERSION = "v1"
SHIPPER_LINE = r"SHIP_ID:\s*(\d+)\s*->\s*(.+)"


# ------------------------------------------------------------------- reading
def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five sources as text columns under their contract names.

    Only contract columns are read: contact names and phone numbers stay in
    the original files.
    """
    absent = [row.name for row in files.missing_files(spark, folder, NORTHWIND_FILES).collect()]
    if absent:
        raise FileNotFoundError(f"missing in {folder}: {', '.join(sorted(absent))}")

    customers = files.read_delimited(spark, f"{folder}/customers.csv").select(
        F.col("CustomerID").alias("customer_id"),
        F.col("CompanyName").alias("company_name"),
        F.col("City").alias("city"),
    )
    products = (
        spark.read.schema(
            "ProductID string, ProductName string, CategoryID string, Specs struct<UnitPrice: string>"
        )
        .option("multiLine", True)
        .json(f"{folder}/products.json")
        .select(
            F.col("ProductID").alias("product_id"),
            F.col("ProductName").alias("product_name"),
            F.col("CategoryID").alias("category_id"),
            F.col("Specs.UnitPrice").alias("unit_price"),
        )
    )
    order_fields = ["OrderID", "CustomerID", "OrderDate", "ShipperID", "Freight"]
    orders = files.office_records(spark, f"{folder}/orders_2026.xlsx", order_fields).select(
        F.col("OrderID").alias("order_id"),
        F.col("CustomerID").alias("customer_id"),
        F.col("OrderDate").alias("order_date"),
        F.col("ShipperID").alias("shipper_id"),
        F.col("Freight").alias("freight"),
    )
    detail_fields = ["OrderID", "ProductID", "UnitPrice", "Quantity", "Discount"]
    details = file_positions(
        files.csv_records(
            spark, f"{folder}/order_details.txt", detail_fields, sep="|", quoted_newlines=False
        ).drop("raw_json")
    ).select(
        F.col("source_row").alias("line_id"),
        F.col("OrderID").alias("order_id"),
        F.col("ProductID").alias("product_id"),
        F.col("UnitPrice").alias("unit_price"),
        F.col("Quantity").alias("quantity"),
        F.col("Discount").alias("discount"),
    )
    shippers = office.keyed_paragraphs(
        office.paragraphs(spark, f"{folder}/shippers_policy.docx"), SHIPPER_LINE, ["shipper_id", "shipper_name"],
        marker="SHIP_ID:",
    ).select("shipper_id", "shipper_name")
    return {
        "customers": customers, "products": products, "orders": orders,
        "order_details": details, "shippers": shippers,
    }


def to_contract(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stripped text in contract types; what does not convert becomes NULL."""

    def convert(name: str, kind: str):
        if kind == "string":
            return text.strip_whitespace(name).alias(name)
        if kind == "date":
            # a date cell with a time of day counts as its day
            return text.strip_whitespace(name).try_cast("timestamp").cast("date").alias(name)
        if kind == "bigint":
            return numbers.lenient_long(F.col(name).cast("string")).alias(name)
        return numbers.lenient_decimal(name, kind).alias(name)

    return {
        table: raw[table].select([convert(name, kind) for name, kind in types.items()])
        for table, types in NORTHWIND_TYPES.items()
    }


# ---------------------------------------------------------------- validation
def unreadable(raw: dict[str, DataFrame]) -> DataFrame:
    """Values that do not fit their contract type, and typed values that are missing.

    ``invalid_number``: no finite number, finer than the contract keeps, or
    broken where a whole number belongs. ``invalid_date``: no date.
    ``required``: a number or date that is NULL or blank. One pass per table,
    however many columns it has.
    """
    parts = []
    for table, types in NORTHWIND_TYPES.items():
        checks = []

        def check(rule: str, name: str, broken) -> None:
            detail = F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("null")))
            checks.append(F.when(broken, F.struct(F.lit(rule).alias("rule"), detail.alias("detail"))))

        for name, kind in types.items():
            if kind == "string" or name == "line_id":
                continue
            if kind == "date":
                check("invalid_date", name, numbers.is_not_a_date(name))
            elif kind == "bigint":
                check("invalid_number", name, numbers.is_not_whole(name))
            else:
                scale = int(kind.rstrip(")").split(",")[1])
                check(
                    "invalid_number", name,
                    numbers.is_bad_number(name, "decimal(38,12)") | numbers.is_overprecise(name, scale),
                )
            if name != next(iter(types)):  # a missing key has a rule of its own
                check("required", name, ~F.coalesce(text.is_present(name), F.lit(False)))
        if checks:
            found = F.explode(F.filter(F.array(*checks), lambda entry: entry.isNotNull()))
            rows = raw[table].withColumn("_bad", found)
            parts.append(
                rows.select(
                    "_bad.rule",
                    F.lit(table).alias("table_name"),
                    F.col(next(iter(types))).cast("string").alias("key"),
                    "_bad.detail",
                )
            )
    return quality.union_all(parts)


def find_violations(data: dict[str, DataFrame], raw: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every blocking rule over the five typed tables."""
    orders, details = data["orders"], data["order_details"]
    parts = [quality.empty_table(df, name) for name, df in data.items()]
    for table, key in NORTHWIND_KEYS.items():
        parts.append(quality.missing_key(data[table], table, key, F.lit(None)))
        parts.append(quality.conflicting_duplicates(data[table], table, key))
    parts += [
        quality.orphans(orders, data["customers"], "orders", "order_id", "customer_id", "customer_id"),
        quality.orphans(orders, data["shippers"], "orders", "order_id", "shipper_id", "shipper_id"),
        quality.negative_freight(orders),
        quality.orphans(details, orders, "order_details", "line_id", "order_id", "order_id"),
        quality.orphans(details, data["products"], "order_details", "line_id", "product_id", "product_id"),
        quality.measure_rules(details),
    ]
    if raw is not None:
        parts.append(unreadable(raw))
    return quality.union_all(parts)


def validate(data: dict[str, DataFrame], raw: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Tables with exact copies collapsed; raises when a rule is broken."""
    quality.gate(find_violations(data, raw))
    clean = dict(data)
    for table, key in NORTHWIND_KEYS.items():
        clean[table], _ = dedup_exact_or_reject(data[table], key)
    return clean


# ------------------------------------------------------------ gold and checks
def gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_customer": silver["customers"],
        "dim_product": silver["products"],
        "dim_shipper": silver["shippers"],
        "dim_date": gold.dim_date_iso(silver["orders"]),
        "fact_orders": gold.fact_orders(silver["orders"]),
        "fact_sales": gold.fact_sales(silver["order_details"], silver["orders"]),
    }


def revenue_reconciliation(details: DataFrame, fact: DataFrame) -> DataFrame:
    """Lines and revenue from the typed source against the fact table.

    The expected amount is worked out from the source lines in whole
    hundredths, not with the expression that filled the fact table.
    """
    cents = F.col("unit_price") * 100 * F.col("quantity") * (F.lit(10000) - F.col("discount") * 10000)
    half_up = F.floor((F.abs(cents) + 5000) / F.lit(10000)) * F.signum(cents).cast("int")
    expected = details.agg(
        F.count("*").alias("source_lines"),
        (F.sum(half_up.cast("decimal(24,0)")) * F.expr("0.01BD")).cast("decimal(18,2)").alias("expected_revenue"),
    )
    actual = fact.agg(
        F.count("*").alias("fact_lines"), F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue")
    )
    agree = F.col("source_lines").eqNullSafe(F.col("fact_lines")) & F.col("expected_revenue").eqNullSafe(
        F.col("net_revenue")
    )
    return publish.side_by_side(expected, actual).withColumn("agrees", agree)


def count_reconciliation(source: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """Rows of each validated source table and of its Silver table."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), F.lit(layer).alias("layer"), "rows")
        for layer, tables in (("source", source), ("silver", silver))
        for name, df in tables.items()
    ]
    counts = quality.union_all(parts).groupBy("table_name").agg(
        F.max(F.when(F.col("layer") == "source", F.col("rows"))).alias("source_rows"),
        F.max(F.when(F.col("layer") == "silver", F.col("rows"))).alias("silver_rows"),
    )
    return counts.withColumn("agrees", F.col("source_rows").eqNullSafe(F.col("silver_rows")))


@dataclass(frozen=True)
class Batch:
    """What a run produced."""

    batch: str
    summary: DataFrame
    view: str | None


def run(spark: SparkSession, folder: str, out: str, validate_only: bool = False,
        view: str = "sales_dashboard") -> Batch:
    """Read, validate, write Silver and Gold, reconcile, then switch the view.

    Nothing is published before every rule and the reconciliation passed. The
    same input content gives the same batch, so a retry writes nothing twice.
    """
    # the digest comes before the rows, and again before they are published: a file replaced in between is seen
    batch = batch_id(spark, folder, NORTHWIND_FILES, MODEL_VERSION)
    # files are parsed once; the rules and Silver read the columnar copy
    raw = {name: stage(df, f"raw-{name}") for name, df in read_raw(spark, folder).items()}
    typed = to_contract(raw)
    clean = validate(typed, raw)
    if validate_only:
        return Batch(batch, publish.row_counts(clean), None)

    publish.archive_raw(spark, folder, NORTHWIND_FILES, batch, f"{out}/bronze/{batch}")
    silver = {
        name: publish.stage_typed(df, NORTHWIND_TYPES[name], f"{out}/silver/{batch}/{name}")
        for name, df in clean.items()
    }
    paths = {name: f"{out}/gold/{batch}/{name}" for name in gold_tables(silver)}
    star = {name: publish.write_once(df, paths[name]) for name, df in gold_tables(silver).items()}

    # five rows, one per table
    differing = [row.asDict() for row in count_reconciliation(clean, silver).collect() if not row.agrees]
    if differing:
        raise publish.BatchError(f"silver does not reconcile with its source: {differing}")
    check = revenue_reconciliation(clean["order_details"], star["fact_sales"]).first()
    if not check.agrees:
        raise publish.BatchError(f"gold does not reconcile with its source: {check.asDict()}")
    if batch_id(spark, folder, NORTHWIND_FILES, MODEL_VERSION) != batch:
        raise publish.BatchError(f"a source file changed during the run: {folder}")

    # the commit comes first; the view only shows what it published
    publish.switch_pointer(spark, f"{out}/gold", batch, paths)
    tables = {f"gold_{batch}_{name}": path for name, path in paths.items()}
    publish.switch_view(
        spark, view, tables,
        f"""SELECT * FROM gold_{batch}_fact_sales
            JOIN (SELECT product_id, product_name, category_id FROM gold_{batch}_dim_product) USING (product_id)
            JOIN (SELECT customer_id, city FROM gold_{batch}_dim_customer) USING (customer_id)
            JOIN gold_{batch}_dim_shipper USING (shipper_id)""",
    )
    return Batch(batch, publish.batch_summary(batch, silver, star["fact_sales"]), view)
