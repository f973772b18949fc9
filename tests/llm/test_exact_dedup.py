from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from granary.llm import exact_dedup
from tests.llm.conftest import odd_rows, prose


def brute(rows: list[tuple]) -> list[tuple]:
    """``id, keep_id, group_size, kept, sha256`` of rows ``id, text``, sorted."""
    groups = defaultdict(list)
    for at, (key, text) in enumerate(rows):
        groups[text or ""].append((key is not None, key or 0, -at))
    found = []
    for text, members in groups.items():
        best = max(members)
        for member in members:
            keep = best[1] if best[0] else None
            own = member[1] if member[0] else None
            found.append((own, keep, len(members), member == best, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=repr)


def result(frame) -> list[tuple]:
    wanted = frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(row) for row in wanted.collect()), key=repr)


def test_against_brute_force(spark):
    rows = [(i, prose(i % 700, 3 + i % 5)) for i in range(2000)]
    rows += [(i, "the same") for i in range(5000, 6000)] + [(None, None), (7, ""), (None, "x"), (None, "x"), (3, "y"), (3, "y")]
    rows += [(-5, prose(1, 30_000)), (-6, prose(1, 30_000) + " "), (-7, prose(1, 30_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(exact_dedup.duplicates(docs)) == brute(rows)
    assert result(exact_dedup.mark(docs)) == brute(rows)


def test_one_row_of_each_text_stays(spark):
    rows = [(i, prose(i % 50, 6), i % 3) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id int").repartition(5)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    latest = {}
    for row in rows:
        latest[row[1]] = row
    assert sorted(tuple(r) for r in kept.collect()) == sorted(latest.values())


@pytest.mark.parametrize("frame", ["odd_documents", "no_documents"])
def test_odd_rows(request, frame):
    docs = request.getfixturevalue(frame)
    marked = exact_dedup.mark(docs)
    assert set(marked.columns) == set(docs.columns) | set(exact_dedup.ADDED)
    rows = [row[:2] for row in odd_rows()] if frame == "odd_documents" else []
    assert result(marked) == brute(rows)
    assert marked.where("_unit <> 7 or _row <> 'r' or n_words <> 'w'").count() == 0
    stays = exact_dedup.deduplicate(docs)
    assert stays.columns == docs.columns and stays.count() == len({text or "" for _, text in rows})


def test_filter_misses_no_repeat_and_passes_most_others(spark):
    rows = spark.range(40_000).select(F.unhex(F.sha2(F.least("id", F.lit(30_000)).cast("string").cast("binary"), 256)).alias("_digest"))
    rows = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("_digest")))
    blocks = exact_dedup.blocks_for(40_000)
    tested = exact_dedup.with_repeated(rows, exact_dedup.repeated_positions(rows.select("_digest"), blocks), blocks)
    counted = tested.groupBy(F.expr("n > 1").alias("again")).agg(F.count_if("_repeated").alias("hit"), F.count(F.lit(1)).alias("all"))
    found = {r.again: (r.hit, r["all"]) for r in counted.collect()}
    assert found[True][0] == found[True][1]
    assert found[False][0] < 0.05 * found[False][1]


def test_a_full_filter_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MOST_BITS", exact_dedup.BLOCK)
    rows = [(i, f"t{i % 30_000}") for i in range(31_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(exact_dedup.duplicates(docs)) == brute(rows)


def test_bitmaps_are_bounded():
    assert exact_dedup.blocks_for(0) == 1
    assert exact_dedup.blocks_for(100_000) * exact_dedup.BLOCK >= 100_000 * exact_dedup.BITS_PER_ROW
    assert exact_dedup.blocks_for(10**13) * exact_dedup.BLOCK == exact_dedup.MOST_BITS


def test_no_python_runs(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    plan = exact_dedup.duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
