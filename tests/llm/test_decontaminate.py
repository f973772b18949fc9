from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from granary.llm import decontaminate
from tests.llm.conftest import prose


def make_items(n: int) -> list[tuple]:
    return [(i, f"{prose(500 + i, 12 + i % 40)}?", prose(900 + i, 3 + i % 12)) for i in range(n)]


ITEMS = "item_id long, question string, answer string"


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(make_items(90), ITEMS)


@pytest.fixture(scope="module")
def index(items):
    return next(decontaminate.index_shards(items))


def brute_scores(documents: list[str]) -> list[dict[int, float]]:
    """Best normalised BM25 score of every item over every passage, without any skipping."""
    segments = []
    for number, question, answer in make_items(90):
        words = decontaminate.words_of(f"{question}\n{answer}")
        segments += [(number, words[i : i + 64]) for i in range(0, len(words), 64)]
    df = Counter(term for _, words in segments for term in set(words))
    mean = sum(len(words) for _, words in segments) / len(segments)
    impacts = []
    for number, words in segments:
        weights = {
            t: math.log(1 + (len(segments) - df[t] + 0.5) / (df[t] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(words) / mean))
            for t, f in Counter(words).items()
        }
        impacts.append((number, {t: w / sum(weights.values()) for t, w in weights.items()}))
    found = []
    for text in documents:
        words, best = decontaminate.words_of(text), {}
        for start in range(0, len(words), 64):
            passage = set(words[start : start + 128])
            for number, weights in impacts:
                score = sum(w for t, w in weights.items() if t in passage)
                if score >= decontaminate.THRESHOLD:
                    best[number] = max(best.get(number, 0), score)
        found.append(best)
    return found


def documents() -> list[str]:
    draw, made = random.Random(7), make_items(90)
    texts = ["", prose(1, 5), prose(2, 2000)]
    for i in range(40):
        _, question, answer = draw.choice(made)
        words = f"{question} {answer}".split()
        kept = [w for w in words if draw.random() < draw.choice([0.5, 0.8, 1.0])]
        texts.append(f"{prose(i, draw.randint(0, 200))} {' '.join(kept)} {prose(i + 50, draw.randint(0, 100))}")
    return texts


@pytest.mark.parametrize("cells", [4_000_000, 40])
def test_search_finds_what_exhaustive_scoring_finds(index, monkeypatch, cells):
    monkeypatch.setattr(decontaminate, "MOST_CELLS", cells)
    texts = documents()
    got = index.search([decontaminate.words_of(text) for text in texts])
    expected = brute_scores(texts)
    assert any(expected)
    for found, wanted in zip(got, expected):
        named = {index.items[place].item_id: score for place, score in found.items()}
        assert named.keys() == wanted.keys()
        assert all(math.isclose(named[i], wanted[i], rel_tol=1e-9) for i in named)


def test_leaks_need_question_and_answer(spark, items):
    made = make_items(90)
    whole = [f"{prose(i, 30)} {q.upper()}  {a} {prose(i, 20)}" for i, q, a in made]
    question_only = [f"{prose(i, 30)} {q} {prose(i + 1, 20)}" for i, q, a in made]
    texts = whole + question_only + [prose(i, 300) for i in range(40)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = decontaminate.find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(i, i) for i in range(90)}
    assert all(r.question_overlap == r.answer_overlap == 1.0 and math.isclose(r.score, 1.0) for r in rows)
    kept = {r.doc_id for r in decontaminate.decontaminate(docs, items).collect()}
    assert kept == set(range(90, len(texts)))


def test_a_copy_with_a_changed_word_is_found_and_half_an_item_is_not(index):
    for number, question, answer in make_items(90)[30:40]:
        words = f"{question} {answer}".split()
        for place in (1, len(words) // 2, len(words) - 1):
            changed = [*words[:place], "other", *words[place + 1 :]]
            leaks = index.leaks([f"{prose(1, 20)} {' '.join(changed)} {prose(2, 20)}"])[0]
            assert [leak["item_id"] for leak in leaks] == ([number] if len(words) > 30 else [leak["item_id"] for leak in leaks])
        assert index.leaks([" ".join(words[: len(words) // 2])])[0] == []


def test_scattered_items_are_found_as_trying_every_item_finds_them(index):
    made, draw, filler = make_items(90), random.Random(13), prose(77, 200)
    texts = [f"{prose(3, 40)} {question} {filler} {answer} {prose(4, 40)}" for _, question, answer in made]
    for _ in range(300):  # cut anywhere, in any order
        _, question, answer = draw.choice(made)
        words = f"{question} {answer}".split()
        cuts = sorted(draw.sample(range(1, len(words)), draw.randint(1, 3)))
        pieces = [" ".join(words[a:b]) for a, b in zip([0, *cuts], [*cuts, len(words)])]
        draw.shuffle(pieces)
        texts.append(f" {filler} ".join(pieces))
    low = 0
    for text, leaks in zip(texts, index.leaks(texts)):
        spaced = f" {' '.join(decontaminate.words_of(text))} "
        expected = set()
        for item in index.items:
            overlap, *parts = item.overlaps(spaced)
            if overlap >= decontaminate.OVERLAP and min(parts) >= decontaminate.PART_COVER:
                expected.add(item.item_id)
        assert {leak["item_id"] for leak in leaks} == expected
        assert all(0 < leak["score"] < 1 + 1e-9 for leak in leaks)
        low += sum(leak["score"] < decontaminate.THRESHOLD for leak in leaks)
    assert low > 10


def test_a_scattered_item_of_few_words_or_many(spark):
    long_question = prose(21, 150)
    rows = [(1, "alpha beta gamma", ""), (2, "one two three four", "five six seven eight nine ten"), (3, long_question, prose(22, 60))]
    index = next(decontaminate.index_shards(spark.createDataFrame(rows, ITEMS)))
    filler = prose(23, 200)
    words = long_question.split()
    halves = f"{' '.join(words[:70])} {filler} {' '.join(words[70:])} {filler} {prose(22, 60)}"
    texts = ["x alpha beta gamma y", "alpha beta x gamma", halves, f"{filler} {filler}"]
    assert [[leak["item_id"] for leak in leaks] for leaks in index.leaks(texts)] == [[1], [], [3], []]


def test_shards_find_what_one_index_finds(spark, items, monkeypatch):
    texts = documents() + [f"{prose(i, 30)} {q} {a} {prose(i, 20)}" for i, q, a in make_items(90)[::5]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one = {tuple(r)[:2] for r in decontaminate.find_leaks(docs, items).collect()}
    assert len(one) >= 18
    monkeypatch.setattr(decontaminate, "SHARD_SEGMENTS", 30)
    assert {tuple(r)[:2] for r in decontaminate.find_leaks(docs, items).collect()} == one
    left = {r.doc_id for r in decontaminate.decontaminate(docs, items).collect()}
    assert left == set(range(docs.count())) - {doc for doc, _ in one}


@pytest.fixture
def twenty_shards(items, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_SEGMENTS", 5)
    shards = [*decontaminate.index_shards(items)]
    assert len(shards) >= 18
    return shards


def test_shards_are_cut_by_their_segments(twenty_shards):
    longest = max(-(-len(item.words) // decontaminate.SEGMENT) for shard in twenty_shards for item in shard.items)
    assert all(0 < len(shard.owner) < 5 + longest for shard in twenty_shards)
    assert sorted(item.item_id for shard in twenty_shards for item in shard.items) == list(range(90))


@pytest.mark.parametrize("a_scan, chars, reads", [(32, 4_000_000, 1), (32, 1, 1), (7, 4_000_000, 3)])
def test_many_shards_take_one_scan_and_find_what_one_index_finds(
    spark, items, index, twenty_shards, monkeypatch, tmp_path, capsys, a_scan, chars, reads
):
    monkeypatch.setattr(decontaminate, "SHARDS_A_SCAN", a_scan)
    monkeypatch.setattr(decontaminate, "CHUNK_CHARS", chars)
    texts = documents() + [f"{prose(i, 30)} {q} {a} {prose(i, 20)}" for i, q, a in make_items(90)[::3]]
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(path)
    found = decontaminate.find_leaks(spark.read.parquet(path), items)
    expected = {
        (doc, leak["item_id"]): leak["score"] for doc, leaks in enumerate(index.leaks(texts)) for leak in leaks
    }
    got = {(row.doc_id, row.item_id): row.score for row in found.collect()}
    assert expected and got.keys() == expected.keys()
    assert all(math.isclose(got[pair], score, rel_tol=1e-9) for pair, score in expected.items())
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("Scan parquet") == reads and plan.count("ArrowEvalPython") == (reads == 1)
    kept = decontaminate.decontaminate(spark.read.parquet(path), items)
    assert {row.doc_id for row in kept.collect()} == set(range(len(texts))) - {doc for doc, _ in expected}


def test_an_item_longer_than_a_shard(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_SEGMENTS", 4)
    rows = [(i, prose(300 + i, 30), prose(400 + i, 8)) for i in range(12)] + [(99, prose(31, 2000), prose(32, 50))]
    items = spark.createDataFrame(rows, ITEMS)
    texts = [f"{prose(5, 50)} {question} {answer}" for _, question, answer in rows] + [prose(6, 500), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    leaks = {(row.doc_id, row.item_id) for row in decontaminate.find_leaks(docs, items).collect()}
    assert leaks == {(i, row[0]) for i, row in enumerate(rows)}


def test_odd_items_and_documents(spark, odd_documents, no_documents, items):
    odd = spark.createDataFrame(
        [(1, None, None), (None, "", ""), (2, prose(1, 40), None), (2, prose(1, 40), None), (3, "?", "!")], ITEMS
    )
    rows = decontaminate.find_leaks(odd_documents, odd).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(4, 2), (4, 2), (4, 2), (5, 2)]
    left = decontaminate.decontaminate(odd_documents, odd)
    assert left.columns == odd_documents.columns and left.count() == odd_documents.count() - 4
    assert decontaminate.find_leaks(no_documents, items).count() == 0
    assert decontaminate.find_leaks(odd_documents, items.limit(0)).count() == 0
    assert decontaminate.decontaminate(odd_documents, items.limit(0)).count() == odd_documents.count()


def test_question_and_answer(spark):
    texts = ["What is it? A cat.", "One sentence only.", "A.\nB c.\n D e", None, ""]
    rows = decontaminate.question_and_answer(spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")).collect()
    assert [(r.question, r.answer) for r in rows] == [
        ("What is it?", "A cat."), ("One sentence only.", ""), ("A.\nB c.", "D e"), ("", ""), ("", ""),
    ]
