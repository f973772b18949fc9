from __future__ import annotations

import random
from fractions import Fraction

from pyspark.sql import functions as F

from granary.llm import mixing
from tests.llm.conftest import prose


def test_targets_reshare_what_is_above_the_limit():
    assert mixing.targets([10, 10, 10], [3, 1, 2]) == [20, Fraction(25, 3), Fraction(50, 3)]
    assert mixing.targets([0, 8], [3, 1]) == [0, 12]
    assert mixing.targets([], []) == []
    assert mixing.targets([0, 0], [3, 1]) == [0, 0]
    sizes = [5, 1000, 30, 7]
    given = mixing.targets(sizes, [3, 1, 2, 3])
    assert all(t <= 2 * s for t, s in zip(given, sizes)) and sum(given) == Fraction(3, 2) * sum(sizes)


def test_quotas_split_exactly():
    quotas = [100, 0, 7, 4096]
    shares = mixing.split_quotas(quotas, 7, seed=3)
    assert [sum(column) for column in zip(*shares)] == quotas
    assert max(map(sum, shares)) - min(map(sum, shares)) <= 3
    assert shares == mixing.split_quotas(quotas, 7, seed=3)


def test_fill_comes_nearest():
    assert sum([3, 5, 9][i] for i in mixing.fill([3, 5, 9], 13)) == 12
    assert mixing.fill([], 10) == []
    assert mixing.fill([4], 3) == [0] and mixing.fill([4], 2) == [] and mixing.fill([4], 0) == []
    assert sum([10, 25][i] for i in mixing.fill([10, 25], 24)) == 25
    many = [7] * 500
    assert sum(many[i] for i in mixing.fill(many, 1400)) == 1400


def frame(spark, n: int):
    draw = random.Random(8)
    rows = [(i, prose(i, draw.randint(1, 50)), f"s{i % 3}" if i % 10 else None) for i in range(n)]
    rows += [(n + i, prose(1, 30), "s1") for i in range(n // 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = frame(spark, 3000)  # sources above and below REGION_DOCS on either side
    mix = mixing.plan(docs, shards=5)
    decided = mixing.decide(docs, mix).collect()
    assert len(decided) == docs.count()
    for source in {r.source for r in decided}:
        rows = [r for r in decided if r.source == source]
        size, taken = sum(r["size"] for r in rows), sum(r["size"] * r.copies for r in rows)
        assert rows[0].source_size == size
        assert abs(taken - rows[0].target) <= 0.01 * rows[0].target
    assert all(0 <= r.copies <= 2 for r in decided)
    again = mixing.decide(docs.repartition(5), mixing.plan(docs.repartition(2), shards=5)).collect()
    assert sorted((r.doc_id, r.copies) for r in decided) == sorted((r.doc_id, r.copies) for r in again)

    mixed = mixing.mixed(docs, mix).collect()
    assert len(mixed) == sum(r.copies for r in decided)
    assert len({(r.doc_id, r.copy) for r in mixed}) == len(mixed)
    per_shard = [sum(r["shard"] == s for r in mixed) for s in range(5)]
    assert sum(per_shard) == len(mixed) and min(per_shard) > 0.6 * max(per_shard)


def test_decisions_name_the_shard_of_each_copy_in_the_mix(spark):
    docs = frame(spark, 1500).withColumn("shards", F.lit("old"))
    mix = mixing.plan(docs, shards=5)
    mixed = {(r.doc_id, r.copy): r["shard"] for r in mixing.mixed(docs, mix).collect()}
    decided = mixing.decide(docs, mix).collect()
    assert {(r.doc_id, copy): shard for r in decided for copy, shard in enumerate(r.shards)} == mixed
    assert {len(r.shards) for r in decided} >= {0, 1} and all(len(r.shards) == r.copies for r in decided)


def test_odd_rows_and_columns(odd_documents, no_documents):
    mix = mixing.plan(odd_documents, shards=2)
    decided = mixing.decide(odd_documents, mix).collect()
    assert len(decided) == odd_documents.count()
    assert all(r.copies == 0 for r in decided if not (r.text or "").split())
    assert {r._unit for r in decided} == {7}
    same = {r.copies for r in decided if r.doc_id == 4}
    assert len(same) == 1
    mixed = mixing.mixed(odd_documents, mix)
    assert {"_row", "copy", "shard", "place"} <= set(mixed.columns)
    assert mixed.count() == sum(r.copies for r in decided)
    assert mixing.mixed(no_documents, mixing.plan(no_documents)).count() == 0


def test_fill_is_the_best_of_all_subsets():
    draw = random.Random(4)
    for _ in range(400):
        words = [draw.randint(0, 40) for _ in range(draw.randint(0, 9))]
        room = draw.randint(0, 200)
        sums = {sum(w for i, w in enumerate(words) if pick >> i & 1) for pick in range(1 << len(words))}
        chosen = mixing.fill(words, room)
        got = sum(words[i] for i in chosen)
        assert len(set(chosen)) == len(chosen)
        assert abs(got - room) == min(abs(s - room) for s in sums)
        assert got == min(s for s in sums if abs(s - room) == abs(got - room))


def test_fill_needs_little_memory_for_long_documents():
    import tracemalloc

    draw = random.Random(6)
    words = [draw.randint(5_000_000, 15_000_000) for _ in range(128)]
    for share in (0.03, 0.5, 0.97):
        room = int(sum(words) * share)
        tracemalloc.start()
        chosen = mixing.fill(words, room)
        assert tracemalloc.get_traced_memory()[1] < 100e6
        tracemalloc.stop()
        assert abs(sum(words[i] for i in chosen) - room) < 0.002 * room


def test_few_very_long_documents(spark):
    rows = [(i, "w " * (20_000 + 977 * i), "long") for i in range(12)] + [(100 + i, prose(i, 20), "short") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    decided = mixing.decide(docs, mixing.plan(docs)).collect()
    for source in ("long", "short"):
        mine = [r for r in decided if r.source == source]
        assert abs(sum(r["size"] * r.copies for r in mine) - mine[0].target) < 0.05 * mine[0].target


def test_shares_are_distributed_like_shuffled_blocks():
    quotas, shards, runs = [6, 3, 9], 3, 4000
    drawn = [mixing.split_quotas(quotas, shards, seed)[0] for seed in range(runs)]
    total, mine = sum(quotas), sum(quotas) // shards
    for i, owned in enumerate(quotas):
        values = [share[i] for share in drawn]
        mean, expected = sum(values) / runs, mine * owned / total
        spread = expected * (1 - owned / total) * (total - mine) / (total - 1)
        assert abs(mean - expected) < 5 * (spread / runs) ** 0.5
        assert abs(sum((v - mean) ** 2 for v in values) / runs - spread) < 0.15 * spread
