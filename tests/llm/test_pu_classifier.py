from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from granary.llm import pu_classifier
from tests.llm.conftest import prose


def junk(seed: int) -> str:
    words = prose(seed, 80).split()
    if seed % 3 == 0:
        return " ".join(word.upper() + "!!" for word in words)
    if seed % 3 == 1:
        return " | ".join(words)
    return " ".join(f"{words[0]}" for _ in words)


def sentences(seed: int) -> str:
    words = prose(seed, 100).split()
    return ". ".join(" ".join(words[i : i + 9]).capitalize() for i in range(0, 100, 9)) + "."


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(3)
    good = {i: draw.random() < 0.8 for i in range(1500)}
    docs = spark.createDataFrame([(i, sentences(i) if good[i] else junk(i)) for i in good], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, int(good[i])) for i in good if draw.random() < 0.5] + [(None, 1), (5, 0), (5, 1)], "doc_id long, quality int"
    )
    return docs.repartition(3).cache(), labels, good


def test_held_out_accuracy(corpus):
    docs, labels, good = corpus
    rows = pu_classifier.score(docs, pu_classifier.fit(docs, labels)).collect()
    assert len(rows) == len(good)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([(r.predicted == 1) == good[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    best = max(r.score for r in rows if not good[r.doc_id])
    assert np.mean([r.score > best for r in rows if good[r.doc_id]]) > 0.9


def test_training_never_sees_held_out_labels(corpus):
    docs, labels, good = corpus
    held = pu_classifier.held_out("doc_id")
    turned = labels.withColumn("quality", pu_classifier.F.when(held, 1 - pu_classifier.F.col("quality")).otherwise(pu_classifier.F.col("quality")))
    one, two = pu_classifier.fit(docs, labels), pu_classifier.fit(docs, turned)
    assert all(np.array_equal(a, b) for a, b in zip(one.weights, two.weights))


def test_prior_comes_near_the_share_of_positives():
    draw = np.random.default_rng(1)
    good, bad = draw.normal(0, 1, (6000, 3)), draw.normal(4, 1, (1200, 3))
    mixed = draw.permutation(np.concatenate([good[:2800], bad]))
    assert abs(pu_classifier.class_prior(good[3000:], mixed) - 0.7) < 0.06


def test_samples_are_bounded_and_spread(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "_id").union(spark.range(5000).selectExpr("7 as _id"))
    taken = [r._id for r in pu_classifier.drawn(ids, 500).collect()]
    assert len(taken) == len(set(taken)) == 500
    assert 8000 < np.mean(taken) < 12_000
    assert taken == [r._id for r in pu_classifier.drawn(ids.repartition(7), 500).collect()]
    assert pu_classifier.drawn(ids, 100_000).count() == 20_000


def test_without_positives_every_score_is_one_half(corpus):
    docs, labels, _ = corpus
    none = labels.where("quality = 2")
    assert pu_classifier.fit(docs, none) is None
    row = pu_classifier.score(docs.limit(1), None).first()
    assert (row.score, row.predicted) == (0.5, 1)


def test_odd_rows_and_columns(corpus, odd_documents, no_documents):
    docs, labels, _ = corpus
    network = pu_classifier.fit(docs, labels)
    rows = pu_classifier.score(odd_documents, network).collect()
    assert len(rows) == odd_documents.count()
    assert all(np.isfinite(r.score) and r._unit == 7 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert pu_classifier.fit(odd_documents, labels) is not None
    assert pu_classifier.fit(no_documents, labels) is None
    assert pu_classifier.score(no_documents, network).count() == 0


def test_slope_of_the_risk_against_differences():
    """One full-batch step moves the last bias against the non-negative risk's numeric slope."""
    draw = np.random.default_rng(3)
    p, u, prior = draw.normal(1, 1, (40, 3)), draw.normal(0, 1, (60, 3)), 0.4

    def risk(logit):
        good, rest = np.logaddexp(0, -logit), np.logaddexp(0, logit)
        a = len(p)
        return prior * good[:a].mean(), rest[a:].mean() - prior * rest[:a].mean()

    both = np.concatenate([p, u])
    logit = pu_classifier.Network(u).logit(both)
    step = 1e-6
    for shift in (0.0, -9.0):  # the second makes the part that cannot be negative so, if anything does
        at = logit + shift
        numeric = np.array([
            (sum(risk(at + step * (np.arange(len(at)) == i))) - sum(risk(at - step * (np.arange(len(at)) == i)))) / (2 * step)
            for i in range(len(at))
        ])
        good, a, b = 1 / (1 + np.exp(-at)), len(p), len(u)
        direct = np.concatenate([prior * (good[:a] - 1 - good[:a]) / a, good[a:] / b])
        assert np.allclose(numeric, direct, atol=1e-6)


def test_repeated_ids_train_alike_in_any_order(corpus):
    docs, labels, _ = corpus
    again = docs.unionByName(docs.withColumn("text", pu_classifier.F.concat("text", pu_classifier.F.lit(" more"))))
    one, two = (pu_classifier.fit(again.repartition(n, "text"), labels) for n in (2, 7))
    assert all(np.array_equal(a, b) for a, b in zip(one.weights, two.weights))
