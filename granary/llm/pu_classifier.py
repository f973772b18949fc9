"""A quality classifier from positives and unlabelled text (PU learning).

Trusted positives are documents labelled good; everything else is unlabelled
web text, whose good and bad documents are not told apart. A small network
minimises the non-negative unbiased risk

    prior * R(positives as good) + max(0, R(unlabelled as bad) - prior * R(positives as bad))

with the logistic loss, so that the score estimates the chance of being good.
The class prior comes from the same samples: a first network learns to tell
positives from unlabelled text on one half, and on the other half the smallest
ratio of the two score tails bounds the share of positives.

Training sees at most ``POSITIVES`` and ``UNLABELLED`` documents, drawn by a
hash of their id: a fixed bound, at any input size. Features are measured on
whole texts. Scoring is one pass over the documents with the weights broadcast.

Defined results: a null text counts as empty; a document without text is scored
like any other; texts of any length are measured whole; equal scores stay
equal, no rank is made of them; a null id is held out; a document labelled both good and bad is
no positive; without positives every score is the prior's start, 0.5; repeated
rows are scored alike; an empty table gives an empty result. Input columns named
like an added one are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import text as T
from granary.llm.frames import shielded, without

POSITIVES = 16_000
UNLABELLED = 24_000
FOLDS = 5
CUT = 0.3
HIDDEN = 16
EPOCHS = 30
BATCH = 512
STEP = 0.01
DECAY = 1e-4
SEED = 11

_SYMBOLS = bytes(i for i in range(256) if chr(i) not in "#*$%&|<>{}[]\\^~_=+@")
_NO_ENDS = bytes(i for i in range(256) if chr(i) not in ".!?")
_NO_EXCLAIM = bytes(i for i in range(256) if chr(i) != "!")
_NO_COMMA = bytes(i for i in range(256) if chr(i) not in ",;:")
_NO_DIGITS = bytes(i for i in range(256) if chr(i) not in "0123456789")


def features(text: str) -> list[float]:
    """Measures of a whole text: lengths, letters, marks, repetition."""
    raw = text.encode("utf-8", "surrogatepass")
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    chars = int(lengths.sum())
    lines = [line for line in text.split("\n") if line.strip()]
    upper = sum(map(str.isupper, words))
    titled = sum(map(str.istitle, words))
    kept = lambda table: len(raw.translate(None, table))
    return [
        math.log(n),
        float(lengths.mean()),
        float(lengths.std()),
        float((lengths <= 3).mean()),
        upper / n,
        titled / n,
        kept(_SYMBOLS) / n,
        kept(_NO_EXCLAIM) / n,
        kept(_NO_ENDS) / n,
        kept(_NO_COMMA) / n,
        kept(_NO_DIGITS) / chars,
        len(raw) / max(1, len(text)) - 1.0,
        math.log(len(counts)) / math.log(n + 1),
        max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        1.0 - len(set(lines)) / len(lines),
        math.log(n / len(lines)),
        len(zlib.compress(raw, 1)) / len(raw),
    ]


N_FEATURES = 18


def _measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([features(text.as_py() or "") for text in texts], pa.list_(pa.float64()))


class Network:
    """One hidden layer over standardised measures; ``logit`` is the log-odds of being good."""

    def __init__(self, background: np.ndarray, seed: int = SEED):
        self.draw = np.random.default_rng(seed)
        self.mean, self.scale = background.mean(axis=0), background.std(axis=0) + 1e-6
        wide = background.shape[1]
        self.weights = [
            self.draw.normal(0, 1 / math.sqrt(wide), (wide, HIDDEN)),
            np.zeros(HIDDEN),
            self.draw.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN),
            np.zeros(1),
        ]
        self.moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        self.steps = 0

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -6, 6)

    def logit(self, rows: np.ndarray) -> np.ndarray:
        return self._forward(self.standard(rows))[1]

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(x @ self.weights[0] + self.weights[1])
        return hidden, hidden @ self.weights[2] + self.weights[3]

    def descend(self, x: np.ndarray, slope: np.ndarray, hidden: np.ndarray) -> None:
        """One Adam step along the risk's ``slope`` by logit."""
        back = slope[:, None] * self.weights[2] * (1 - hidden**2)
        grads = [x.T @ back, back.sum(axis=0), hidden.T @ slope, slope.sum(keepdims=True)]
        self.steps += 1
        for weight, grad, (first, second) in zip(self.weights, grads, self.moments):
            grad = grad + DECAY * weight
            first += 0.1 * (grad - first)
            second += 0.001 * (grad**2 - second)
            rate = STEP * math.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
            weight -= rate * first / (np.sqrt(second) + 1e-8)

    def train(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> Network:
        """Minimise the non-negative risk under ``prior``, or without one tell positives from unlabelled."""
        p, u = self.standard(positive), self.standard(unlabelled)
        rounds = max(1, -(-(len(p) + len(u)) // BATCH))
        for _ in range(EPOCHS):
            p_parts = np.array_split(self.draw.permutation(len(p)), rounds)
            u_parts = np.array_split(self.draw.permutation(len(u)), rounds)
            for p_part, u_part in zip(p_parts, u_parts):
                if not len(p_part) or not len(u_part):
                    continue
                x = np.concatenate([p[p_part], u[u_part]])
                hidden, logit = self._forward(x)
                good = 1 / (1 + np.exp(-logit))  # slope of the loss as bad; good - 1 that of the loss as good
                a, b = len(p_part), len(u_part)
                if prior is None:
                    slope = np.concatenate([(good[:a] - 1) / a, good[a:] / b])
                else:
                    as_bad = np.logaddexp(0, logit)
                    rest = as_bad[a:].mean() - prior * as_bad[:a].mean()
                    if rest >= 0:
                        slope = np.concatenate([prior * (good[:a] - 1 - good[:a]) / a, good[a:] / b])
                    else:  # the part that cannot be negative is; undo it
                        slope = np.concatenate([prior * good[:a] / a, -good[a:] / b])
                self.descend(x, slope, hidden)
        return self


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in unlabelled text: the least ratio of score tails, with a margin for chance."""
    p_half, u_half = len(positive) // 2, len(unlabelled) // 2
    if p_half < 10 or u_half < 10:
        return 0.5
    told = Network(unlabelled[:u_half]).train(positive[:p_half], unlabelled[:u_half], None)
    p, u = np.sort(told.logit(positive[p_half:])), np.sort(told.logit(unlabelled[u_half:]))
    cuts = np.quantile(p, np.linspace(0, 0.95, 200))
    p_tail = 1 - np.searchsorted(p, cuts, side="left") / len(p)
    u_tail = 1 - np.searchsorted(u, cuts, side="left") / len(u)
    margin = math.sqrt(math.log(40) / (2 * len(u))) + math.sqrt(math.log(40) / (2 * len(p)))
    best = int(np.argmin((u_tail + margin) / p_tail))
    return float(np.clip(u_tail[best] / p_tail[best], 0.05, 0.98))


def held_out(id_column: str) -> Column:
    """Whether the id's checksum puts a row into the fold that is never learnt from."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def drawn(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` of the different ``_id``, those of lowest hash.

    A table of more ids is thinned by hash to about twice as many first, so
    that a task hands on a few of its ids and not ``most`` of them.
    """
    rows = ids.count()
    place = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("_id")), 11)  # 53 bits
    low = ids.where(place < min(1 << 53, (2 * most << 53) // max(1, rows)))
    return low.distinct().orderBy(place, "_id").limit(most)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id") -> Network | None:
    """A trained network, or None without positives. ``labels`` has the id and ``quality``."""
    ids = docs.select(F.col(id_column).alias("_id")).where(~held_out("_id"))
    good = (
        labels.select(F.col(id_column).alias("_id"), "quality")
        .where(~held_out("_id"))
        .groupBy("_id")
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
    )
    positives = drawn(good.select("_id"), POSITIVES).withColumn("_good", F.lit(True))
    others = drawn(ids, UNLABELLED).withColumn("_good", F.lit(False))
    taken = positives.unionByName(others)  # at most POSITIVES + UNLABELLED ids
    measures = F.arrow_udf(_measured, "array<double>")
    # an id may repeat, however often: the least of its texts' measures is the one that is taken
    sample = (
        docs.select(F.col(id_column).alias("_id"), T.whole(text).alias("_text"))
        .join(F.broadcast(taken), "_id")
        .select("_good", "_id", measures("_text").alias("x"))
        .groupBy("_good", "_id")
        .agg(F.min("x").alias("x"))
        .collect()
    )
    sample.sort(key=lambda row: (row._id, row.x))
    positive, unlabelled = (np.array([row.x for row in sample if row._good is kind]) for kind in (True, False))
    if not len(positive) or not len(unlabelled):
        return None
    draw = np.random.default_rng(SEED)
    positive, unlabelled = draw.permutation(positive), draw.permutation(unlabelled)
    return Network(unlabelled).train(positive, unlabelled, class_prior(positive, unlabelled))


@shielded
def score(docs: DataFrame, network: Network | None, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``."""
    docs = without(docs, *({"held_out", "score", "predicted"} - {text, id_column}))
    if network is None:
        scored = docs.withColumn("score", F.lit(0.5))
    else:
        shared = docs.sparkSession.sparkContext.broadcast((network.weights, network.mean, network.scale))

        def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = Network(np.zeros((1, N_FEATURES)))
            model.weights, model.mean, model.scale = shared.value
            for texts in batches:
                rows = np.array([features(text.as_py() or "") for text in texts]).reshape(-1, N_FEATURES)
                yield pa.array(1 / (1 + np.exp(-model.logit(rows))), pa.float64())

        scored = docs.withColumn("score", F.arrow_udf(scores, "double")(T.whole(text)))
    return scored.withColumns(
        {"held_out": held_out(id_column), "predicted": F.when(F.col("score") >= CUT, 1).otherwise(0)}
    )
