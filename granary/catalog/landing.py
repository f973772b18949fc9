"""Bronze shaping, keys, text extraction and content hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.catalog.registry import query
from granary.functions import text
from granary.operators.dedup import dedup_exact
from granary.operators.fingerprint import group_fingerprint, manifest_diff
from granary.operators.ordering import dense_number
from granary.plans import bronze, northwind
from granary.sources import office, sample

ASSIGNMENT = r'(\w+)\s*=\s*"([^"]+)"'


@query(
    "regex_kv_extract",
    r"""SELECT doc_id, regexp_extract(line, '(\w+)\s*=\s*"([^"]+)"', 1) AS name,
               regexp_extract(line, '(\w+)\s*=\s*"([^"]+)"', 2) AS value
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
        WHERE regexp_matches(line, '(\w+)\s*=\s*"([^"]+)"')""",
)
def regex_kv_extract(spark, folder):
    """First assignment of every line that has one, over all documents."""
    lines = sample.table(spark, folder, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return office.keyed_paragraphs(lines, ASSIGNMENT, ["name", "value"], "line", marker="=")


@query(
    "shipper_paragraphs",
    "SELECT CAST(s_suppkey AS VARCHAR) AS shipper_id, s_name AS shipper_name FROM supplier",
)
def shipper_paragraphs(spark, folder):
    """Shipper rows recovered from policy paragraphs that also hold other lines."""
    paragraph = F.explode(
        F.array(
            F.lit("Shipping policy"),
            F.concat(F.lit("Rule: SHIP_ID:  "), F.col("s_suppkey").cast("string"), F.lit(" ->  "), F.col("s_name"),
                     F.lit(" \t")),
            F.concat(F.lit("SHIP_ID: none -> "), F.col("s_name")),
        )
    )
    paragraphs = sample.table(spark, folder, "supplier").select(paragraph.alias("text"))
    return office.keyed_paragraphs(paragraphs, northwind.SHIPPER_LINE, ["shipper_id", "shipper_name"], marker="SHIP_ID:")


@query(
    "json_field_projection",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_field_projection(spark, folder):
    parsed = F.from_json("props", "k bigint")
    return sample.table(spark, folder, "events").select("event_id", parsed.getField("k").alias("k"))


FINGERPRINT_COLUMNS = ["order_id", "line_number", "product_id", "unit_price", "quantity", "discount"]


@query(
    "content_fingerprint",
    """SELECT supplier_id, rows, sha256(concat_ws('|', rows, a, b, c, d, e, f, g, h)) AS fingerprint FROM (
           SELECT supplier_id, count(*) AS rows, sum(n1 // 1048576) AS a, sum(n1 % 1048576) AS b,
                  sum(n2 // 1048576) AS c, sum(n2 % 1048576) AS d, sum(n3 // 1048576) AS e, sum(n3 % 1048576) AS f,
                  sum(n4 // 1048576) AS g, sum(n4 % 1048576) AS h
           FROM (SELECT supplier_id, ('0x' || substr(digest, 1, 10))::BIGINT AS n1,
                        ('0x' || substr(digest, 11, 10))::BIGINT AS n2, ('0x' || substr(digest, 21, 10))::BIGINT AS n3,
                        ('0x' || substr(digest, 31, 10))::BIGINT AS n4
                 FROM (SELECT supplier_id, sha256(concat_ws('|', order_id, line_number, product_id, unit_price,
                              quantity, discount)) AS digest FROM lines))
           GROUP BY supplier_id)""",
)
def content_fingerprint(spark, folder):
    return group_fingerprint(sample.lines(spark, folder), ["supplier_id"], FINGERPRINT_COLUMNS)


@query(
    "manifest_diff",
    """SELECT CAST(product_id AS VARCHAR) AS name,
              CASE WHEN product_id % 5 = 0 THEN 'new' WHEN product_id % 7 = 0 THEN 'missing'
                   WHEN product_id % 11 = 0 THEN 'conflict' ELSE 'same' END AS state
       FROM (SELECT DISTINCT product_id FROM lines) WHERE NOT (product_id % 5 = 0 AND product_id % 7 = 0)""",
)
def manifest_diff_query(spark, folder):
    """Two manifests of the same lines, with planted gaps and changes."""
    lines = sample.lines(spark, folder)

    def manifest(df):
        hashed = group_fingerprint(df, ["product_id"], FINGERPRINT_COLUMNS)
        return hashed.select(F.col("product_id").cast("string").alias("name"), F.col("fingerprint").alias("digest"))

    changed = F.when(F.col("product_id") % 11 == 0, F.col("quantity") + 1).otherwise(F.col("quantity"))
    existing = manifest(lines.filter("product_id % 5 <> 0"))
    incoming = manifest(lines.filter("product_id % 7 <> 0").withColumn("quantity", changed))
    return manifest_diff(existing, incoming)


@query(
    "bronze_conform",
    """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id,
              CAST(quantity AS VARCHAR) AS quantity, CAST(unit_price AS VARCHAR) AS unit_price,
              CAST(discount AS VARCHAR) AS discount, CAST(NULL AS VARCHAR) AS coupon
       FROM lines""",
)
def bronze_conform(spark, folder):
    fields = ["order_id", "product_id", "quantity", "unit_price", "discount", "coupon"]
    return bronze.conform(sample.lines(spark, folder), fields)


@query(
    "bronze_snapshot_orders",
    """SELECT order_id, customer_id, order_date, order_status, payment_method,
              TIMESTAMP '2026-01-01 02:00:00' AS _extract_ts, 'storefront_order' AS _source
       FROM headers""",
)
def bronze_snapshot_orders(spark, folder):
    orders = sample.order_header(spark, folder).drop("coupon_code")
    return bronze.with_lineage(orders, "storefront_order", "2026-01-01 02:00:00")


@query(
    "surrogate_key",
    """SELECT row_number() OVER (ORDER BY order_id, product_id, line_number, supplier_id, ship_date, raw_price)
                  AS sale_key, order_id, product_id, line_number, supplier_id
       FROM lines""",
)
def surrogate_key(spark, folder):
    order = ["order_id", "product_id", "line_number", "supplier_id", "ship_date", "raw_price"]
    numbered = dense_number(sample.lines(spark, folder).select(*order), order, "sale_key")
    return numbered.select("sale_key", "order_id", "product_id", "line_number", "supplier_id")


@query(
    "union_sources",
    """SELECT 'customer' AS source, c_custkey AS party_id, c_name AS name, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
              c_mktsegment AS segment FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name, CAST(s_acctbal AS DECIMAL(18,2)), NULL FROM supplier
       UNION ALL SELECT 'nation', n_nationkey, n_name, NULL, NULL FROM nation""",
)
def union_sources(spark, folder):
    """Party records of three sources with different fields."""
    customers = sample.table(spark, folder, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = sample.table(spark, folder, "supplier").select(
        F.lit("supplier").alias("source"), F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("balance"),
    )
    nations = sample.table(spark, folder, "nation").select(
        F.lit("nation").alias("source"), F.col("n_nationkey").cast("bigint").alias("party_id"),
        F.col("n_name").alias("name"),
    )
    return customers.unionByName(suppliers, allowMissingColumns=True).unionByName(nations, allowMissingColumns=True)


@query("dedup_exact", "SELECT * FROM people")
def dedup_exact_query(spark, folder):
    """Every fifth customer arrives twice."""
    customers = sample.customers(spark, folder)
    return dedup_exact(customers.unionByName(customers.filter("customer_id % 5 = 0")))


@query(
    "normalize_codes",
    """SELECT p_partkey AS product_id, upper(p_brand) || '-' || p_partkey AS sku FROM part""",
)
def normalize_codes(spark, folder):
    typed_in = F.concat(F.lit("\t "), F.lower("p_brand"), F.lit("-"), F.col("p_partkey").cast("string"), F.lit(" \n"))
    return sample.table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), text.clean_code(typed_in).alias("sku")
    )
