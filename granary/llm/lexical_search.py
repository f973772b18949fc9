"""Ranked lexical search: the best documents of every item, by dual-tree search.

A document's coordinates are the impacts of the items' terms in it, an item's
are its terms' weights; the score is their product, in whole numbers. Items and
documents stand in trees whose nodes hold, for each coordinate, the maximum of
what is below. The product of two nodes' maxima bounds every score between
them, so a pair of nodes whose bound is below the weakest k-th score of its
items is dropped with all that is under it; what is left at the leaves is
scored exactly. No document that belongs in a result is lost.

Passes over the data: one cuts the texts into terms and keeps each document's
counts of the items' terms; the document frequencies and lengths are summed
from those narrow rows; then trees of ``TREE_DOCS`` documents are searched
where they lie. Rounds make the bounds strong: the first, over documents picked
by hash, only finds good k-th scores; the second, over all others, starts from
them and sends on little more than what enters a result. Together they search
every document once.

Items come to the driver in passes of at most ``PASS_TERMS`` distinct term
places (an item of more is a pass of its own) and are broadcast in blocks of at
most ``BLOCK_CELLS`` item-by-term cells; a worker holds one block. The documents
are read once a pass, so once for some 20,000 items of 50 terms.

Defined results: a null text has no terms; a document or item without terms is
in no result; texts of any length are counted whole; equal scores go by
ascending id, a null id last, and rows equal in both are ranked in any order;
each row of the items is an item of its own and each row of the documents a
document, repeated or not; empty tables give an empty result. Other input
columns are not needed and are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary import session
from granary.llm import text as T
from granary.operators.ordering import running_total

PASS_TERMS = 1 << 20
BLOCK_CELLS = 1 << 21
TREE_DOCS = 1024
FANOUT = 8
ROUNDS = 64  # one in so many documents is searched first
NO_ID = 2**63 - 1  # stands for a null id, last in order

# bytes that end a term become spaces; A-Z become a-z; all others, those above ASCII included, stay
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms(raw: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return raw.translate(_FOLD).split()


# ------------------------------------------------------------------ documents
def _counted(batches: Iterator[pa.RecordBatch], places: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    kinds = pa.list_(pa.int32())
    for batch in batches:
        lengths, known, times = [], [], []
        for raw in batch.column(1).to_pylist():
            found = terms(raw)
            lengths.append(len(found))
            mine = [(places[term], n) for term, n in Counter(found).items() if term in places]
            known.append([place for place, _ in mine])
            times.append([n for _, n in mine])
        yield pa.record_batch(
            [batch.column(0), pa.array(lengths, pa.int64()), pa.array(known, kinds), pa.array(times, kinds)],
            names=["doc_id", "n", "terms", "times"],
        )


def counted(docs: DataFrame, places: dict[bytes, int], text: str, id_column: str) -> DataFrame:
    """``doc_id, n, terms, times`` of the documents that have terms; only known terms are listed, by their places."""
    held = docs.sparkSession.sparkContext.broadcast(places)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), T.whole(text).cast("binary").alias("raw"))
    return rows.mapInArrow(
        lambda batches: _counted(batches, held.value), "doc_id long, n long, terms array<int>, times array<int>"
    ).where("n > 0")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        place, n = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
        seen.update(dict(zip(place.tolist(), n.tolist())))
    yield pa.record_batch(
        [pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["term", "df"]
    )


def weight(documents: int, frequency: int) -> int:
    """A term's weight from the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


# ---------------------------------------------------------------------- trees
def _alike(rows: np.ndarray) -> np.ndarray:
    """Order in which rows with the same strongest coordinates follow each other."""
    if rows.shape[1] < 2:
        return np.arange(len(rows))
    top = np.argpartition(rows, -2, axis=1)[:, -2:]
    values = np.take_along_axis(rows, top, 1)
    first = values.argmax(axis=1)
    at = np.arange(len(rows))
    return np.lexsort((values.max(axis=1), top[at, 1 - first], top[at, first]))


def _levels(leaves: np.ndarray) -> list[np.ndarray]:
    """Maxima of the leaves, root first: every node stands for ``FANOUT`` nodes of the next level."""
    levels = [leaves]
    while len(levels[0]) > 1:
        levels.insert(0, np.maximum.reduceat(levels[0], np.arange(0, len(levels[0]), FANOUT), axis=0))
    return levels


class Items:
    """A block of items: their tree over the block's own terms."""

    def __init__(self, numbers: list[int], listed: list[list[int]], weights: dict[int, int]):
        self.places = np.unique(np.array([p for own in listed for p in own], dtype=np.int64))
        at = {int(p): i for i, p in enumerate(self.places)}
        heavy = max((sum(weights[p] for p in own) for own in listed), default=0)
        # every product and sum is whole; doubles hold them exactly up to 2^53
        self.kind = np.float64 if heavy * 10**6 < 2**53 else np.int64
        dense = np.zeros((len(listed), len(self.places)), self.kind)
        for row, own in enumerate(listed):
            dense[row, [at[p] for p in own]] = [weights[p] for p in own]
        order = _alike(dense)
        self.numbers = np.array(numbers, dtype=np.int64)[order]
        self.levels = _levels(dense[order])


def impacts(times: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Impact of a term that occurs so often in a document of that length."""
    size = 10 + (90 * lengths * documents) // total
    return (1_000_000_000 * times) // (1000 * times + 8 * size)


class Best:
    """The k best scores of each item of a block, and what a score must beat."""

    def __init__(self, items: int, k: int, floors: np.ndarray):
        self.k = k
        self.scores = [np.zeros(0, np.int64)] * items
        self.ids = [np.zeros(0, np.int64)] * items
        self.least = np.maximum(floors, 1)  # lowest score that may still enter

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[item], scores]), np.concatenate([self.ids[item], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[item], self.ids[item] = scores[order], ids[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], int(scores[order[-1]]))


def search(items: Items, docs: np.ndarray, ids: np.ndarray, best: Best) -> int:
    """Bring the documents (rows of impacts) into ``best``; the number of exact scores it took."""
    order = _alike(docs)
    docs, ids = docs[order], ids[order]
    doc_levels, item_levels = _levels(docs), items.levels
    scored = 0

    def weakest(level: int) -> np.ndarray:
        """Lowest score that may enter any item below each node of a level."""
        least = best.least
        for _ in range(len(item_levels) - 1 - level):
            least = np.minimum.reduceat(least, np.arange(0, len(least), FANOUT))
        return least

    # both trees go down to pairs of a node above document leaves and one item, the higher tree first
    doc_at, item_at = 0, 0
    pairs, bound = np.zeros((1, 2), np.int64), np.zeros(1)
    while len(pairs):
        rows, columns = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
        bounds = doc_levels[doc_at][rows] @ item_levels[item_at][columns].T
        bound = bounds[np.searchsorted(rows, pairs[:, 0]), np.searchsorted(columns, pairs[:, 1])]
        keep = bound >= weakest(item_at)[pairs[:, 1]]
        pairs, bound = pairs[keep], bound[keep]
        doc_left, item_left = max(0, len(doc_levels) - 2 - doc_at), len(item_levels) - 1 - item_at
        if not doc_left and not item_left:
            break
        down = (doc_left > 0 and doc_left >= item_left, item_left > 0 and item_left >= doc_left)
        for side, levels, level in ((0, doc_levels, doc_at), (1, item_levels, item_at)):
            if down[side]:
                child = pairs[:, side, None] * FANOUT + np.arange(FANOUT)
                pairs = np.repeat(pairs, FANOUT, axis=0)
                pairs[:, side] = child.ravel()
                pairs = pairs[pairs[:, side] < len(levels[level + 1])]
        doc_at, item_at = doc_at + down[0], item_at + down[1]
    # the most promising documents of an item first: their scores raise what the rest must beat
    width = FANOUT if len(doc_levels) - 1 - doc_at else 1
    order = np.lexsort((-bound, pairs[:, 1]))
    pairs, bound = pairs[order], bound[order]
    starts = np.flatnonzero(np.diff(pairs[:, 1], prepend=-1))
    for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(pairs)]):
        item, done = int(pairs[low, 1]), low
        own = np.flatnonzero(item_levels[-1][item])
        weights = item_levels[-1][item, own]
        while done < high and bound[done] >= best.least[item]:
            # more and more at a time: the first few settle most of the threshold
            end = min(high, done + max(4, done - low))
            nodes = pairs[done:end][bound[done:end] >= best.least[item], 0]
            done = end
            at = (nodes[:, None] * width + np.arange(width)).ravel()
            at = at[at < len(docs)]
            scores = (docs[at[:, None], own] @ weights).astype(np.int64)
            scored += len(at)
            enters = np.flatnonzero(scores >= best.least[item])
            if len(enters):
                best.add(item, scores[enters], ids[at[enters]])
    return scored


# ---------------------------------------------------------------------- Spark
_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Documents in groups of ``TREE_DOCS``."""
    held, count = [], 0
    for batch in batches:
        while batch.num_rows:
            some = batch.slice(0, TREE_DOCS - count)
            batch = batch.slice(some.num_rows)
            held.append(some)
            count += some.num_rows
            if count == TREE_DOCS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _searched(batches: Iterator[pa.RecordBatch], blocks: list, floors: dict[int, int], documents: int, total: int, k: int):
    kept: list[Best] = []
    for tree in _trees(batches):
        listed, times = tree.column("terms").combine_chunks(), tree.column("times").combine_chunks()
        lengths = tree.column("n").to_numpy()
        owner = np.repeat(np.arange(len(listed)), listed.value_lengths().to_numpy())
        place = listed.flatten().to_numpy().astype(np.int64)
        value = impacts(times.flatten().to_numpy().astype(np.int64), lengths[owner], documents, total)
        ids = tree.column("doc_id").fill_null(NO_ID).to_numpy()
        for number, block in enumerate(blocks):
            items: Items = block.value
            if number == len(kept):
                kept.append(Best(len(items.numbers), k, np.array([floors.get(int(n), 0) for n in items.numbers], dtype=np.int64)))
            at = np.minimum(np.searchsorted(items.places, place), len(items.places) - 1)
            mine = items.places[at] == place
            rows, inverse = np.unique(owner[mine], return_inverse=True)  # the others score 0
            if not len(rows):
                continue
            dense = np.zeros((len(rows), len(items.places)), items.kind)
            dense[inverse, at[mine]] = value[mine]
            search(items, dense, ids[rows], kept[number])
            if len(blocks) > 1:
                block.unpersist_local()
    for block, best in zip(blocks, kept):
        own = np.repeat(block.value.numbers, [len(scores) for scores in best.scores])
        yield pa.record_batch(
            [pa.array(own, pa.int64()), pa.array(np.concatenate(best.ids)), pa.array(np.concatenate(best.scores))], schema=_FOUND
        )


class _Block:
    """A broadcast block of items, of which a worker holds one at a time."""

    def __init__(self, broadcast):
        self.broadcast = broadcast

    @property
    def value(self) -> Items:
        return self.broadcast.value

    def unpersist_local(self) -> None:
        """Forget the worker's copy; Spark's own stays on the executor's disk and is read again."""
        self.broadcast.__dict__.pop("_value", None)


def _blocks(items: list[tuple[int, list[int]]], weights: dict[int, int]) -> list[Items]:
    """Items (number, places) in blocks of at most BLOCK_CELLS cells."""
    blocks, numbers, listed, seen = [], [], [], set()
    for number, own in items:
        grown = seen | set(own)
        if numbers and (len(numbers) + 1) * len(grown) > BLOCK_CELLS:
            blocks.append(Items(numbers, listed, weights))
            numbers, listed, grown = [], [], set(own)
        numbers.append(number)
        listed.append(own)
        seen = grown
    return [*blocks, *([Items(numbers, listed, weights)] if numbers else [])]


def _best_of(found: DataFrame, k: int) -> DataFrame:
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def _search_pass(docs: DataFrame, items: list, k: int, text: str, id_column: str) -> DataFrame | None:
    """``item, doc_id, score, rank`` for one pass of items ``(number, terms)``."""
    spark = docs.sparkSession
    places: dict[bytes, int] = {}
    placed = [(number, [places.setdefault(bytes(t), len(places)) for t in own]) for number, own in items]
    rows = session.stage(counted(docs, places, text, id_column), "term-counts")
    whole = rows.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
    if not whole.documents:
        return None
    # one row a term of the pass
    counts = rows.select("terms").mapInArrow(_frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    frequency = {row.term: row.df for row in counts}
    weights = {place: weight(whole.documents, frequency.get(place, 0)) for place in places.values()}
    blocks = [_Block(spark.sparkContext.broadcast(block)) for block in _blocks(placed, weights)]
    documents, total = whole.documents, whole.total

    def found(some: DataFrame, floors: dict[int, int]) -> DataFrame:
        held = spark.sparkContext.broadcast(floors)
        return some.mapInArrow(
            lambda batches: _searched(batches, blocks, held.value, documents, total, k), "item long, doc_id long, score long"
        )

    turn = F.pmod(F.xxhash64("doc_id", "n"), F.lit(ROUNDS)) == 0
    first = session.stage(_best_of(found(rows.where(turn), {}), k), "first-round")
    # one row an item of the pass
    floors = {row["item"]: row.score for row in first.where(F.col("rank") == k).collect()}
    rest = found(rows.where(~turn), floors)
    return _best_of(first.drop("rank").unionByName(rest), k)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [list(dict.fromkeys(terms(raw))) for raw in batch.column(2).to_pylist()]
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.binary())), pa.array([len(x) for x in own], pa.int64())],
            names=["item", "item_id", "terms", "n"],
        )


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", id_column: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` documents of the highest scores above 0."""
    spark = docs.sparkSession
    listed = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), T.whole(item_text).cast("binary").alias("raw")
    ).mapInArrow(_item_terms, f"item long, item_id {items.schema[item_id].dataType.simpleString()}, terms array<binary>, n long")
    listed = session.stage(listed.where("n > 0"), "item-terms")
    passes = session.stage(
        running_total(listed, [], ["item"], "n", "upto").withColumn("pass", F.floor((F.col("upto") - F.col("n")) / PASS_TERMS)),
        "item-passes",
    )
    results = []
    for row in passes.select("pass").distinct().orderBy("pass").collect():
        mine = passes.where(F.col("pass") == row["pass"]).orderBy("item").select("item", "terms").collect()
        result = _search_pass(docs, [(r["item"], r.terms) for r in mine], k, text, id_column)
        if result is not None:
            results.append(session.stage(result, "ranked"))
    if not results:
        schema = f"item_id {items.schema[item_id].dataType.simpleString()}, rank int, doc_id long, score long"
        return spark.createDataFrame([], schema)
    ranked = results[0]
    for result in results[1:]:
        ranked = ranked.unionByName(result)
    return ranked.join(passes.select("item", "item_id"), "item").select(
        "item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score"
    )
