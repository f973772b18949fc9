"""Ordering, running totals, deduplication and fingerprints against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from granary import session
from granary.operators import quality
from granary.operators.dedup import conflicting_keys, dedup_exact_or_reject, dedup_first, dedup_least
from granary.operators.fingerprint import group_fingerprint
from granary.operators.ordering import dense_number, running_total


@pytest.fixture(autouse=True)
def every_partition_stays(spark):
    """Small data would otherwise be merged into one slice."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def ledger(spark, rows=5000, seed=1):
    """Movements with one product that holds a third of them and many equal times."""
    rng = random.Random(seed)
    data = []
    for number in range(rows):
        product = 7 if rng.random() < 0.34 else rng.choice([None, *range(40)])
        data.append((number, product, rng.randrange(20), rng.randrange(-9, 10)))
    return data, spark.createDataFrame(data, "id bigint, product bigint, at bigint, change bigint")


def expected_totals(data):
    totals, result = {}, {}
    for number, product, _, change in sorted(data, key=lambda r: (r[2], r[0])):
        totals[product] = totals.get(product, 0) + change
        result[number] = totals[product]
    return result


def test_running_total(spark):
    """A key that holds most rows and small ones: right totals, whatever the slices."""
    data, frame = ledger(spark)
    result = running_total(frame, ["product"], ["at", "id"], "change", "balance").collect()
    assert len(result) == len(data)
    assert {row.id: row.balance for row in result} == expected_totals(data)


def test_hot_key_rows_spread_over_slices(spark):
    from granary.operators.ordering import ordered_slices

    _, frame = ledger(spark, rows=20000)
    hot = ordered_slices(frame.filter("product = 7"), ["product", "at", "id"])
    assert hot.select("_slice").distinct().count() > 1


def test_dense_number(spark):
    data, frame = ledger(spark)
    numbered = dense_number(frame, ["at", "id"], "n").collect()
    expected = {row[0]: position for position, row in enumerate(sorted(data, key=lambda r: (r[2], r[0])), start=1)}
    assert {row.id: row.n for row in numbered} == expected
    assert numbered[0].__fields__ == ["id", "product", "at", "change", "n"]


def test_dense_number_of_nothing(spark):
    _, frame = ledger(spark, rows=5)
    assert dense_number(frame.limit(0), ["at", "id"], "n").collect() == []


def test_dedup_first(spark):
    rows = [("a", "f2", 1), ("a", "f1", 9), ("a", "f1", 5), ("b", "f3", 2)]
    frame = spark.createDataFrame(rows, "order_id string, source_file string, bronze_id bigint")
    first = dedup_first(frame, ["order_id"], ["source_file", "bronze_id"])
    assert sorted(first.collect()) == [("a", "f1", 5), ("b", "f3", 2)]


def test_dedup_exact_or_reject(spark):
    rows = [(1, "x", None), (1, "x", None), (2, "y", 1), (2, "y", None), (3, "z", 2), (None, "n", 1)]
    frame = spark.createDataFrame(rows, "id int, name string, n int")
    kept, conflicts = dedup_exact_or_reject(frame, "id")
    assert sorted(kept.collect(), key=str) == sorted([(1, "x", None), (3, "z", 2), (None, "n", 1)], key=str)
    assert [row.id for row in conflicts.collect()] == [2]
    assert [row.id for row in conflicting_keys(frame, "id").collect()] == [2]


def test_fingerprint_ignores_order_and_counts_copies(spark):
    base = [(1, "a", 1), (1, "b", 2), (2, "a", 1)]

    def prints(rows):
        frame = spark.createDataFrame(rows, "g int, name string, n int")
        return {row.g: (row.rows, row.fingerprint) for row in group_fingerprint(frame, ["g"], ["name", "n"]).collect()}

    assert prints(base) == prints(base[::-1])
    assert prints(base + [(1, "a", 1), (1, "a", 1)])[1] != prints(base)[1]
    assert prints([(1, None, 1)])[1] != prints([(1, "", 1)])[1]


def test_gate_counts_per_rule(spark):
    frame = spark.createDataFrame([(1, "paid"), (2, "lost"), (3, None)], "order_id int, status string")
    found = quality.not_accepted(frame, "orders", "order_id", "status", ["paid"])
    assert sorted((row.key, row.detail) for row in found.collect()) == [("2", "status=lost"), ("3", "status=null")]
    with pytest.raises(quality.QualityError, match="accepted_values on orders: 2"):
        quality.gate(found)
    quality.gate(found.filter("false"))


def test_rejected_inserts(spark):
    incoming = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "sku string")
    existing = spark.createDataFrame([("c",)], "sku string")
    found = quality.rejected_inserts(incoming, existing, "product", "sku").collect()
    assert {(row.rule, row.key) for row in found} == {("already_exists", "c"), ("duplicate_key", "b")}


def test_orphans_with_null_key(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 5)], "id int, fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    found = quality.orphans(child, parent, "child", "id", "fk", "pk").collect()
    assert {(row.key, row.detail) for row in found} == {("2", "fk=null"), ("3", "fk=5")}
    assert quality.accepted_by(child, parent, "fk", "pk").select(F.col("id")).collect() == [(1,)]


def test_set_difference(spark):
    one = spark.createDataFrame([("a",), ("b",), ("b",)], "name string")
    two = spark.createDataFrame([("b",), ("c",)], "name string")
    assert sorted(quality.set_difference(one, two).collect()) == [
        ("a", "missing"), ("b", "missing"), ("c", "unexpected")]
    assert quality.set_difference(one, one).isEmpty()


def test_drop_staged(spark):
    from granary import session

    staged = session.stage(spark.range(3), "gone")
    folder = f"{session.shared_folder(spark)}/{spark.sparkContext.applicationId}"
    assert staged.count() == 3 and session.exists(spark, folder)
    session.drop_staged(spark)
    assert not session.exists(spark, folder)


def test_dedup_least_is_dedup_first_on_a_total_order(spark):
    rows = [(n % 7, (n * 31) % 5 or None, n % 3, str(n)) for n in range(200)]
    frame = spark.createDataFrame(rows, "key int, a int, b int, tag string")
    least = dedup_least(frame, ["key"], ["a", "b", "tag"])
    assert least.columns == frame.columns
    assert sorted(map(str, least.collect())) == sorted(map(str, dedup_first(frame, ["key"], ["a", "b", "tag"]).collect()))
    assert least.where("key is null").isEmpty() and dedup_least(frame.limit(0), ["key"], ["a", "b", "tag"]).isEmpty()


def test_dedup_least_takes_whole_rows_and_null_keys(spark):
    frame = spark.createDataFrame([(None, 2, "x"), (None, 1, None), (1, 1, "b"), (1, 1, "a")], "key int, a int, tag string")
    least = dedup_least(frame, ["key"], ["a"])
    assert {tuple(row) for row in least.collect()} == {(None, 1, None), (1, 1, "a")}


def test_scratch_scope_tells_what_was_staged_inside(spark):
    with session.scratch_scope() as outer:
        kept = session.stage(spark.range(3), "kept")
        with session.scratch_scope() as inner:
            session.stage(spark.range(2), "gone")
    assert len(inner) == 1 and outer[1:] == inner
    session.drop_paths(spark, [*inner, *inner])
    assert kept.count() == 3 and [session.exists(spark, path) for path in outer] == [True, False]
    with session.scratch_scope() as later:
        pass
    assert later == [] and session.scratch_path(spark, "x") not in outer
