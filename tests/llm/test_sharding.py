from __future__ import annotations

import random
import zlib

import pytest

from granary.llm import sharding
from tests.llm.conftest import prose


def check(rows, shards: int):
    """Sizes, checksums, groups in one place, slots without gaps."""
    slots, homes = {}, {}
    for row in rows:
        raw = (row.text or "").encode()
        assert row["size"] == len(raw) + 1 and row.text_crc32 == zlib.crc32(raw)
        assert 0 <= row["shard"] < shards
        assert homes.setdefault(row.text or "", row["shard"]) == row["shard"]
        slots.setdefault(row["shard"], []).append(row.slot)
    for taken in slots.values():
        assert sorted(taken) == list(range(len(taken)))


def test_least_loaded_gives_the_heap_schedule():
    assert sharding.least_loaded([(7,), (6,), (5,), (4,), (3,)], 2) == [0, 1, 1, 0, 0]
    assert sharding.least_loaded([], 3) == []


@pytest.mark.parametrize("heavy, slices", [(4096, 4096), (3, 5)])
def test_sharding_is_whole_and_even(spark, monkeypatch, heavy, slices):
    monkeypatch.setattr(sharding, "HEAVY", heavy)
    monkeypatch.setattr(sharding, "ROWS_PER_SLICE", slices)
    draw = random.Random(4)
    texts = [prose(i, draw.randint(1, 60)) for i in range(300)] + ["copy of one text"] * 150 + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = sharding.shard(docs, 4).collect()
    assert len(rows) == len(texts)
    check(rows, 4)
    load = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(4)]
    assert max(load) - min(load) < 0.02 * sum(load)
    again = sharding.shard(docs.repartition(2), 4).collect()
    assert {(r.doc_id, r["shard"], r.slot) for r in rows} == {(r.doc_id, r["shard"], r.slot) for r in again}


def test_odd_rows_and_columns(odd_documents, no_documents):
    rows = sharding.shard(odd_documents, 3).collect()
    assert len(rows) == odd_documents.count()
    check(rows, 3)
    assert {r._row for r in rows} == {"r"}
    assert sharding.shard(no_documents, 3).count() == 0


def test_heap_schedule_against_all_schedules():
    """Largest-first never exceeds 4/3 - 1/(3m) of the best possible greatest load."""
    import itertools
    import random

    draw = random.Random(2)
    for _ in range(60):
        sizes, shards = [draw.randint(1, 30) for _ in range(draw.randint(1, 8))], draw.randint(2, 3)
        given = sharding.least_loaded([(size, i) for i, size in enumerate(sizes)], shards)
        load = max(sum(s for s, g in zip(sizes, given) if g == n) for n in range(shards))
        best = min(
            max(sum(s for s, g in zip(sizes, way) if g == n) for n in range(shards))
            for way in itertools.product(range(shards), repeat=len(sizes))
        )
        assert load <= best * (4 / 3 - 1 / (3 * shards)) + 1e-9


def test_bundles_are_as_even_as_single_groups(spark):
    import random

    draw = random.Random(3)
    rows = [(i, f"text {i % 3000} " * draw.choice([1, 2, 30])) for i in range(6000)]
    loads = {}
    for heavy, bundles in ((sharding.HEAVY, sharding.BUNDLES), (1 << 40, sharding.BUNDLES)):
        before = sharding.HEAVY
        try:
            sharding.HEAVY = heavy
            placed = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
        finally:
            sharding.HEAVY = before
        loads[heavy] = [sum(r["size"] for r in placed if r["shard"] == n) for n in range(4)]
    for load in loads.values():
        assert max(load) - min(load) < 0.01 * max(load)
