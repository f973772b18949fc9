from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from granary.llm import lexical_search
from tests.llm.conftest import odd_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text: str | None) -> list[str]:
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    """``item_id, rank, doc_id, score`` by scoring every document for every item."""
    cuts = [(key, cut(text)) for key, text in docs]
    cuts = [(key, Counter(own), len(own)) for key, own in cuts if own]
    documents, total = len(cuts), sum(n for _, _, n in cuts)
    df = Counter(term for _, own, _ in cuts for term in own)
    found = []
    for item, text in items:
        scores = []
        for key, own, n in cuts:
            m, score = 100 - 90 + 90 * n * documents // total, 0
            for term in set(cut(text)):
                w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[term] + 1)))
                score += w * (1000000000 * own[term] // (1000 * own[term] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0))
        for rank, (score, none, key) in enumerate(sorted(scores)[:k], 1):
            found.append((item, rank, None if none else key, -score))
    return sorted(found, key=repr)


def result(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed: int, count: int, longest: int) -> list[str]:
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdeéß1") for _ in range(draw.randint(1, 4))) for _ in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [
        draw.choice([" ", "-", "\n"]).join(draw.choices(vocabulary, weights, k=draw.randint(0, longest))) for _ in range(count)
    ]


@pytest.mark.parametrize("cells, pass_terms, k", [(1 << 21, 1 << 20, 10), (600, 120, 3), (1 << 21, 1 << 20, 100)])
def test_against_brute_force(spark, monkeypatch, cells, pass_terms, k):
    monkeypatch.setattr(lexical_search, "BLOCK_CELLS", cells)
    monkeypatch.setattr(lexical_search, "PASS_TERMS", pass_terms)
    texts = corpus(1, 1500, 60)
    texts += texts[:200] * 2 + ["The SAME text! again"] * 700 + [" ".join(corpus(2, 400, 200))]
    docs = [(3 * i % 2403, text) for i, text in enumerate(texts)]
    items = [(i, text.upper() if i % 2 else text) for i, text in enumerate(corpus(3, 40, 12))] + [(99, "again same"), (99, "again same")]
    frame = lexical_search.rank_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string").repartition(3), k,
    )
    assert result(frame) == brute(docs, items, k)


def test_every_pair_dropped_was_below_the_threshold():
    draw = np.random.default_rng(4)
    common = np.linspace(0.5, 0.002, 300)
    dense = np.where(draw.random((3000, 300)) < common, draw.integers(5 * 10**5, 10**6, (3000, 300)), 0).astype(float)
    weights = {i: int(1000 * np.log(1 / p)) for i, p in enumerate(common)}
    listed = [sorted(draw.choice(300, draw.integers(1, 9), replace=False).tolist()) for _ in range(70)]
    items = lexical_search.Items(list(range(70)), listed, weights)
    best = lexical_search.Best(70, 10, np.zeros(70, np.int64))
    scored = 0
    for low in range(0, 3000, 500):
        some = dense[low : low + 500][:, items.places]
        scored += lexical_search.search(items, some, np.arange(low, low + len(some)), best)
    assert scored < 0.5 * 3000 * 70
    for row, number in enumerate(items.numbers.tolist()):
        exact = dense[:, listed[number]] @ np.array([weights[p] for p in listed[number]], dtype=float)
        order = [i for i in np.lexsort((np.arange(3000), -exact))[:10] if exact[i] > 0]
        assert best.ids[row].tolist() == order and best.scores[row].tolist() == exact[order].astype(int).tolist()


def test_whole_numbers_beyond_doubles():
    items = lexical_search.Items([0], [[0, 1]], {0: 2**40, 1: 1})
    assert items.kind is np.int64
    best = lexical_search.Best(1, 1, np.zeros(1, np.int64))
    lexical_search.search(items, np.array([[4000, 1], [4000, 2]], dtype=np.int64), np.array([5, 6]), best)
    assert best.scores[0].tolist() == [4000 * 2**40 + 2]


def test_odd_rows(spark, odd_documents):
    items = [(None, "ra the"), (1, None), (2, ""), (3, "?!"), (4, "one"), (4, "one ONE Ä"), (5, "a b c d ß"), (6, "ra " * 30_000 + "lo")]
    frame = spark.createDataFrame([(*row, 1, 2) for row in items], "item_id long, text string, item int, n int")
    assert result(lexical_search.rank_documents(odd_documents, frame)) == brute([row[:2] for row in odd_rows()], items, 10)


def test_empty_tables(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    for docs, asked in ((no_documents, items), (odd_documents, items.limit(0)), (no_documents, items.limit(0))):
        frame = lexical_search.rank_documents(docs, asked)
        assert frame.count() == 0 and [t for _, t in frame.dtypes] == ["bigint", "int", "bigint", "bigint"]
