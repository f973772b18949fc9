from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from granary.llm import simhash
from granary.llm.components import components
from tests.llm.conftest import odd_rows, prose


def brute_print(text: str | None) -> int:
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if counts[bit] * 2 > len(shingles))


def brute_roots(prints: list[int], radius: int) -> list[int]:
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = np.array(prints, dtype=np.uint64)
    for x, y in zip(*np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= radius)):
        x, y = find(int(x)), find(int(y))
        if x != y:
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def clustered(seed: int, clusters: int, each: int, alone: int) -> list[int]:
    draw = np.random.default_rng(seed)
    found = {int(x) for x in draw.integers(0, 2**64, alone, dtype=np.uint64)}
    for centre in draw.integers(0, 2**64, clusters, dtype=np.uint64):
        for _ in range(each):
            value = int(centre)
            for bit in draw.choice(64, draw.integers(0, 9), replace=False):
                value ^= 1 << int(bit)
            found.add(value)
    return sorted(found)


def test_fingerprints_against_brute_force():
    texts = [row[1] for row in odd_rows()] + ["a b c", "A b\tc\nd e f", "x " * 50, "é É é É", "\x1c a\xa0b c"]
    for text in texts:
        if text is None or len(text) < 5000:
            assert simhash.fingerprint((text or "").encode()) == brute_print(text), repr(text)


@pytest.mark.parametrize("radius", [1, 4])
def test_a_tree_finds_every_link(radius):
    prints = np.array(clustered(1, 3, 60, 40), dtype=np.uint64)
    places = np.arange(len(prints))
    found = {
        (x, y)
        for left, right in simhash.Tree(prints, places).links(prints, places, radius)
        for x, y in zip(left.tolist(), right.tolist())
    }
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    assert found == {(int(x), int(y)) for x, y in zip(*np.nonzero(apart <= radius))}


def test_any_number_of_bands_holds_every_close_pair(spark, monkeypatch):
    prints = clustered(2, 6, 120, 200)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame(list(zip(signed, range(len(signed)))), "_print long, doc_id long").repartition(3)
    expected = dict(zip(signed, brute_roots(prints, 4)))
    for mean, shard in ((256, 4096), (256, 40), (0, 4096)):
        monkeypatch.setattr(simhash, "MEAN_SHARD", mean)
        monkeypatch.setattr(simhash, "SHARD", shard)
        got = {r._print: r.component_id for r in simhash.classes(nodes).collect()}
        assert got == expected


def test_band_masks_grow_with_the_nodes():
    few, many = simhash.band_masks(1000, 4), simhash.band_masks(10**9, 4)
    assert len(few) == 5 and len(many) > len(few)
    union = 0
    for mask in few:
        assert not union & mask
        union |= mask
    assert union == 2**64 - 1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_odd_rows_and_columns(odd_documents, no_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    prints = {(r.doc_id, r.fingerprint) for r in rows}
    assert prints == {(row[0], f"{brute_print(row[1]):016x}") for row in odd_rows()}
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {0}
    kept = simhash.deduplicate(odd_documents)
    assert kept.columns == odd_documents.columns
    assert kept.count() == len({r.fingerprint for r in rows})
    assert {r.doc_id for r in kept.collect()} >= {0, 3, 4, 6}
    assert simhash.near_duplicates(no_documents).count() == 0
    assert simhash.deduplicate(no_documents).count() == 0


def test_deduplicate_keeps_one_of_each_group(spark):
    base = prose(9, 400)
    rows = [(i, base if i < 50 else f"{base} tail{i}" if i < 60 else prose(i, 300)) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = {r.doc_id for r in simhash.deduplicate(docs).collect()}
    roots = brute_roots([brute_print(text) for _, text in rows], 4)
    assert kept == set(roots)
    found = simhash.near_duplicates(docs).groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.component_id for r in found} == set(roots)
