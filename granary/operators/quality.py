"""Data-quality rules: each gives violations, the gate stops a batch on any."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.dedup import conflicting_keys

VIOLATION_COLUMNS = ["rule", "table_name", "key", "detail"]


class QualityError(ValueError):
    """A batch broke a blocking rule."""


def violations(df: DataFrame, rule: str, table: str, key: str | Column, detail: str | Column) -> DataFrame:
    """Offending rows in the common violation shape."""
    key = F.col(key) if isinstance(key, str) else key
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return df.select(
        F.lit(rule).alias("rule"),
        F.lit(table).alias("table_name"),
        key.cast("string").alias("key"),
        detail.cast("string").alias("detail"),
    )


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), parts)


def missing_key(df: DataFrame, table: str, key: str, row_label: str | Column) -> DataFrame:
    """Rows whose key is NULL or the empty string."""
    absent = F.col(key).isNull() | (F.col(key).cast("string") == "")
    return violations(df.filter(absent), "missing_key", table, row_label, f"missing {key}")


def conflicting_duplicates(df: DataFrame, table: str, key: str) -> DataFrame:
    return violations(conflicting_keys(df, key), "conflicting_duplicate", table, key, f"conflicting {key}")


def empty_table(df: DataFrame, table: str) -> DataFrame:
    """One violation when the table has no row; looks at one row only."""
    seen = df.select(F.lit(1).alias("seen")).limit(1).agg(F.count("*").alias("rows"))
    return violations(seen.filter("rows = 0"), "empty_table", table, F.lit(table), "no rows")


def orphans(df: DataFrame, parent: DataFrame, table: str, key: str | Column, fk: str, parent_key: str) -> DataFrame:
    """Rows whose foreign key is not in the parent table, NULL included."""
    # distinct parent keys are not needed: an anti join looks only for a match
    keys = parent.select(F.col(parent_key).alias(fk))
    return violations(df.join(keys, fk, "left_anti"), "orphan", table, key, F.concat(
        F.lit(f"{fk}="), F.coalesce(F.col(fk).cast("string"), F.lit("null"))
    ))


def accepted_by(df: DataFrame, parent: DataFrame, fk: str, parent_key: str) -> DataFrame:
    """Rows whose foreign key is in the parent table."""
    return df.join(parent.select(F.col(parent_key).alias(fk)), fk, "left_semi")


def outside(df: DataFrame, ok: Column, rule: str, table: str, key: str | Column, detail: str | Column) -> DataFrame:
    """Rows that fail a condition; a condition that is unknown fails as well."""
    return violations(df.filter(~F.coalesce(ok, F.lit(False))), rule, table, key, detail)


def not_accepted(df: DataFrame, table: str, key: str | Column, column: str, allowed: list[str]) -> DataFrame:
    """Values of an enumeration column that are not in its list."""
    text = F.coalesce(F.col(column), F.lit("null"))
    return outside(df, F.col(column).isin(*allowed), "accepted_values", table, key,
                   F.concat(F.lit(f"{column}="), text))


def measure_rules(details: DataFrame, key: str | Column = "line_id", table: str = "order_details") -> DataFrame:
    """Positive quantity, non-negative price, discount between 0 and 1.

    One pass over the lines: each row is tested against all three rules.
    """
    broken = F.filter(
        F.array(
            F.when(~F.coalesce(F.col("quantity") > 0, F.lit(False)), "quantity"),
            F.when(~F.coalesce(F.col("unit_price") >= 0, F.lit(False)), "unit_price"),
            F.when(~F.coalesce(F.col("discount").between(0, 1), F.lit(False)), "discount"),
        ),
        lambda name: name.isNotNull(),
    )
    rows = details.withColumn("_broken", F.explode(broken))
    return violations(rows, "measure_range", table, key, F.col("_broken"))


def negative_freight(orders: DataFrame) -> DataFrame:
    return outside(orders, F.col("freight") >= 0, "negative_freight", "orders", "order_id", "freight")


def duplicate_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    """Keys that occur more than once."""
    counted = df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return violations(counted, "duplicate_key", table, key, F.concat(F.lit("rows="), F.col("n").cast("string")))


def rejected_inserts(incoming: DataFrame, existing: DataFrame, table: str, key: str) -> DataFrame:
    """Keys that a load would insert although they exist or repeat in the load."""
    taken = violations(
        incoming.select(key).distinct().join(existing.select(key), key, "left_semi"),
        "already_exists", table, key, f"{key} exists",
    )
    return taken.unionByName(duplicate_keys(incoming, table, key))


def set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, duplicates counted; none when equal."""
    missing = expected.exceptAll(actual).withColumn("state", F.lit("missing"))
    return missing.unionByName(actual.exceptAll(expected).withColumn("state", F.lit("unexpected")))


def gate(found: DataFrame) -> None:
    """Raise with a count per rule and table when there is any violation."""
    # one row per rule and table: as small as the rule list
    counts = found.groupBy("rule", "table_name").agg(F.count("*").alias("n"), F.min("key").alias("example")).collect()
    if counts:
        lines = sorted(f"{c['rule']} on {c['table_name']}: {c['n']} (e.g. {c['example']})" for c in counts)
        raise QualityError("; ".join(lines))
