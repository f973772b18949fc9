"""Benchmark decontamination: BM25 with block-max WAND, then question and answer overlap.

The index holds the test items, cut into segments of at most ``SEGMENT`` words;
every document is a row of queries, passages of two segments' length that start
every ``SEGMENT`` words, so any run of a segment's length lies inside one of
them. Impacts are BM25 weights divided by the segment's score against itself: a
score is the share of a segment's weight that a passage holds, and every
segment above the threshold is wanted, not a best few.

Pivots are sought in two steps. For a batch of passages at once, block maxima
are added up by passage and block of segments; the commonest terms, whose joint
share is bounded, enter as that bound. A block that stays below the threshold
cannot hold a pivot and is skipped. In the others WAND walks its cursors: the
pivot is the first segment where the cursors' maxima reach the threshold.

An item whose words lie too far apart for one passage, such as a question whose
answer stands at the document's end, is found by its rarest shingles: of so many
that no more could be missing, one must occur anywhere in the document. So every
item that could be verified is retrieved; its score may then be below the
threshold.

An item found either way counts only if at least ``OVERLAP`` of its five-word
shingles occur in the whole document, and the shingles found cover at least
``PART_COVER`` of the words of its question and of its answer, so that neither
stands for the other.

Index statistics are computed in Spark, over all items. Items in the order of
their keys are cut into shards wherever ``SHARD_SEGMENTS`` segments are full, so a
shard holds at most so many and the rest of one item; each is built in a task and
written packed. The driver hands one packed shard after another to a broadcast,
up to ``SHARDS_A_SCAN`` of them for a scan of the documents. A worker takes about
``CHUNK_CHARS`` characters of documents at a time through all shards of the scan,
one unpacked at once. Larger benchmarks take a scan for each so many shards.

Defined results: null and empty documents hold nothing; items without words
are never found; an item shorter than five words must occur as a whole; an item
without an answer is held to its question alone; equal items are
reported by each id; documents of any length are searched whole, passage by
passage; of passages that score alike the best score is the same, so ties need no order; repeated documents are searched alike; an empty table on
either side gives no leaks. Other columns stay as they are.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary import session
from granary.llm import text as T
from granary.llm.frames import shielded, without
from granary.operators.ordering import running_total

SEGMENT = 64
SHINGLE = 5
OVERLAP = 0.8
PART_COVER = 0.5
THRESHOLD = 0.6
BLOCK = 4
SHARD_SEGMENTS = 4096
SHARDS_A_SCAN = 32  # packed, some megabytes each
CHUNK_CHARS = 4_000_000
K1, B = 1.2, 0.75
MOST_CELLS = 4_000_000
ROUNDING = 1e-9  # scores are summed in no fixed order
MIX = np.uint64(0x9E3779B97F4A7C15)

WORDS = re.compile(r"\w+")
LEAK = "array<struct<item_id:long,score:double,overlap:double,question_overlap:double,answer_overlap:double>>"
ARROW_LEAK = pa.list_(
    pa.struct(
        [
            ("item_id", pa.int64()),
            ("score", pa.float64()),
            ("overlap", pa.float64()),
            ("question_overlap", pa.float64()),
            ("answer_overlap", pa.float64()),
        ]
    )
)

_workers: dict[str, Index] = {}


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


class Item:
    """A test item's words, and where its answer begins."""

    def __init__(self, item_id: int | None, question: str, answer: str):
        self.item_id = item_id
        asked, answered = words_of(question), words_of(answer)
        self.words, self.answer_at = asked + answered, len(asked)
        starts = range(max(1, len(self.words) - SHINGLE + 1)) if self.words else ()
        self.shingles = [f" {' '.join(self.words[i : i + SHINGLE])} " for i in starts]

    def overlaps(self, document: str) -> tuple[float, float, float]:
        """Share of the shingles in a document's spaced words; share of question and answer words they cover."""
        found = [i for i, shingle in enumerate(self.shingles) if shingle in document]
        covered = {i + k for i in found for k in range(SHINGLE) if i + k < len(self.words)}
        answered = sum(i >= self.answer_at for i in covered)
        parts = ((len(covered) - answered, self.answer_at), (answered, len(self.words) - self.answer_at))
        question, answer = (part / whole if whole else 1.0 for part, whole in parts)
        return len(found) / max(1, len(self.shingles)), question, answer


def _runs(ids: np.ndarray, length: int) -> np.ndarray:
    """A key of the ``length`` terms from each place on; equal runs have equal keys."""
    keys = np.zeros(max(0, len(ids) - length + 1), dtype=np.uint64)
    for i in range(length):
        keys = (keys + ids[i : i + len(keys)].astype(np.uint64)) * MIX
    return keys


class Index:
    """One shard of the inverted index: postings by term, with maxima over blocks of segments."""

    def __init__(self, postings: list[tuple[int, str, float]], items: list[Item], owner: list[int], threshold: float):
        self.items, self.owner, self.threshold = items, owner, threshold
        terms = sorted({term for _, term, _ in postings})
        self.terms = {term: i for i, term in enumerate(terms)}
        by_term: list[list[tuple[int, float]]] = [[] for _ in terms]
        for segment, term, impact in postings:
            by_term[self.terms[term]].append((segment, impact))
        self.blocks = -(-len(owner) // BLOCK)
        self.lists, self.maxima = [], []
        for listed in by_term:
            listed.sort()
            top: dict[int, float] = {}
            for segment, impact in listed:
                top[segment // BLOCK] = max(top.get(segment // BLOCK, 0.0), impact)
            self.lists.append(([s for s, _ in listed], [x for _, x in listed]))
            self.maxima.append(top)
        # the commonest terms, as long as their joint share of any segment is at most half the threshold
        share, common = np.zeros(len(owner)), set()
        for term in sorted(range(len(terms)), key=lambda t: (-len(by_term[t]), t)):
            more = share.copy()
            for segment, impact in by_term[term]:
                more[segment] += impact
            if more.max(initial=0.0) > threshold / 2:
                break
            share = more
            common.add(term)
        padded = np.zeros(self.blocks * BLOCK)
        padded[: len(share)] = share
        self.common_share = padded.reshape(-1, BLOCK).max(axis=1) if self.blocks else padded
        starts, cells, values = [0], [], []
        for term, top in enumerate(self.maxima):
            if term not in common:
                cells += top.keys()
                values += top.values()
            starts.append(len(cells))
        self.starts, self.cells = np.array(starts), np.array(cells, dtype=np.int64)
        self.values = np.array(values, dtype=np.float64)
        self.rare = self._rarest_runs()

    def _rarest_runs(self) -> dict[int, tuple[np.ndarray, list[list[int]]]]:
        """By length the keys of the items' rarest shingles, and the items of each.

        An item has as many as cannot all be missing where ``OVERLAP`` of its shingles are found.
        """
        runs = [_runs(self._ids(item.words), min(SHINGLE, len(item.words))).tolist() for item in self.items]
        holders = Counter(key for keys in runs for key in set(keys))
        rare: dict[int, dict[int, list[int]]] = {}
        for place, (item, keys) in enumerate(zip(self.items, runs)):
            if item.words:
                spared = len(keys) - math.ceil(OVERLAP * len(keys) - ROUNDING)
                listed = rare.setdefault(min(SHINGLE, len(item.words)), {})
                for key in {*sorted(keys, key=lambda key: holders[key])[: spared + 1]}:
                    listed.setdefault(key, []).append(place)
        return {
            length: (np.array(sorted(listed), dtype=np.uint64), [listed[key] for key in sorted(listed)])
            for length, listed in rare.items()
        }

    def _ids(self, words: list[str]) -> np.ndarray:
        """The index's numbers of words, -1 where it has none."""
        return np.array([self.terms.get(word, -1) for word in words], dtype=np.int64)

    def scattered(self, documents: list[np.ndarray]) -> list[set[int]]:
        """For each document, given by its words' numbers, the items one of whose rarest shingles it holds."""
        found: list[set[int]] = [set() for _ in documents]
        gap = np.array([-1])
        ids = np.concatenate([gap, *(part for words in documents for part in (words, gap))])
        ends = np.cumsum([1 + len(words) for words in documents])
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        for length, (keys, holders) in self.rare.items():
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            mine = _runs(ids, length)[at]
            place = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
            hit = keys[place] == mine
            owners = np.searchsorted(ends, at[hit])
            for pair in np.unique(owners * len(keys) + place[hit]).tolist():
                found[pair // len(keys)].update(holders[pair % len(keys)])
        return found

    def best_score(self, item: int, ids: np.ndarray) -> float:
        """The most that a passage holds of a segment of the item."""
        weights: dict[int, dict[int, float]] = {s: {} for s, owner in enumerate(self.owner) if owner == item}
        for term in {self.terms[word] for word in self.items[item].words}:
            for segment, impact in zip(*self.lists[term]):
                if segment in weights:
                    weights[segment][term] = impact
        best = 0.0
        for start in range(0, len(ids), SEGMENT):
            passage = set(ids[start : start + 2 * SEGMENT].tolist())
            best = max([best, *(sum(x for t, x in held.items() if t in passage) for held in weights.values())])
        return best

    def pivots(self, terms: np.ndarray, halves: np.ndarray, joined: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Half passages that begin a passage with live blocks, and those blocks.

        ``terms`` and ``halves`` are the words known to the index and the half passage of each;
        ``joined`` tells for each half whether the next one continues its document.
        """
        pairs = np.unique(halves * len(self.terms) + terms)
        halves, terms = pairs // len(self.terms), pairs % len(self.terms)
        step = max(2, MOST_CELLS // max(1, self.blocks))
        for low in range(0, len(joined), step - 1):
            high = min(low + step, len(joined))
            a, b = np.searchsorted(halves, [low, high])
            counts = (self.starts[1:] - self.starts[:-1])[terms[a:b]]
            ends = np.cumsum(counts)
            at = np.repeat(self.starts[terms[a:b]] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)
            cell = np.repeat(halves[a:b] - low, counts) * self.blocks + self.cells[at]
            bound = np.bincount(cell, weights=self.values[at], minlength=(high - low) * self.blocks)
            bound = bound.reshape(-1, self.blocks)
            first = high - low if high == len(joined) else high - low - 1
            following = np.vstack([bound[1:], np.zeros((1, self.blocks))])[:first]
            reached = bound[:first] + following * joined[low : low + first, None] + self.common_share
            live = reached >= self.threshold - ROUNDING
            for half in np.flatnonzero(live.any(axis=1)).tolist():
                yield low + half, np.flatnonzero(live[half]).tolist()
            if high == len(joined):
                break

    def wand(self, terms: list[int], block: int) -> Iterator[tuple[int, float]]:
        """Segments of ``block`` that score at least the threshold against a passage's ``terms``."""
        low, high = block * BLOCK, (block + 1) * BLOCK
        cursors = []  # segment at, place, segments, impacts, maximum in the block
        for term in terms:
            if top := self.maxima[term].get(block):
                segments, impacts = self.lists[term]
                place = bisect_left(segments, low)
                cursors.append([segments[place], place, segments, impacts, top])
        while cursors:
            cursors.sort(key=lambda cursor: cursor[0])
            bound, pivot = 0.0, None
            for cursor in cursors:
                bound += cursor[4]
                if bound >= self.threshold - ROUNDING:
                    pivot = cursor[0]
                    break
            if pivot is None:
                return
            if cursors[0][0] == pivot:
                total = sum(cursor[3][cursor[1]] for cursor in cursors if cursor[0] == pivot)
                if total >= self.threshold - ROUNDING:
                    yield pivot, total
                pivot += 1
            for cursor in cursors:
                if cursor[0] < pivot:
                    cursor[1] = bisect_left(cursor[2], pivot, cursor[1])
                    cursor[0] = cursor[2][cursor[1]] if cursor[1] < len(cursor[2]) else high
            cursors = [cursor for cursor in cursors if cursor[0] < high]

    def search(self, documents: list[list[str]]) -> list[dict[int, float]]:
        """For each document the items that a passage holds and their best score."""
        return self._search([self._ids(words) for words in documents])

    def _search(self, documents: list[np.ndarray]) -> list[dict[int, float]]:
        found: list[dict[int, float]] = [{} for _ in documents]
        if not self.terms:
            return found
        known, places, owners, first = [], [], [], 0
        for number, ids in enumerate(documents):
            halves = -(-len(ids) // SEGMENT)
            known.append(ids)
            places.append(np.arange(len(ids)) // SEGMENT + first)
            owners += [number] * halves
            first += halves
        if not owners:
            return found
        terms, halves, owner = np.concatenate(known), np.concatenate(places), np.array(owners)
        keep = terms >= 0
        terms, halves = terms[keep], halves[keep]
        joined = np.append(owner[1:] == owner[:-1], False)
        for half, blocks in self.pivots(terms, halves, joined):
            a, b = np.searchsorted(halves, [half, half + 1 + bool(joined[half])])
            passage = np.unique(terms[a:b]).tolist()
            scores = found[owners[half]]
            for block in blocks:
                for segment, score in self.wand(passage, block):
                    item = self.owner[segment]
                    scores[item] = max(scores.get(item, 0.0), score)
        return found

    def leaks(self, texts: list[str]) -> list[list[dict]]:
        """Verified items of each text."""
        return self.leaks_in([words_of(text) for text in texts])

    def leaks_in(self, documents: list[list[str]]) -> list[list[dict]]:
        """Verified items of each document, given by its words."""
        numbers = [self._ids(words) for words in documents]
        verified = []
        for words, ids, scores, scattered in zip(documents, numbers, self._search(numbers), self.scattered(numbers)):
            leaks = []
            spaced = f" {' '.join(words)} " if scores or scattered else ""
            for place in sorted(scores.keys() | scattered):
                item = self.items[place]
                overlap, question, answer = item.overlaps(spaced)
                if overlap >= OVERLAP and question >= PART_COVER and answer >= PART_COVER:
                    score = scores[place] if place in scores else self.best_score(place, ids)
                    leaks.append(
                        {
                            "item_id": item.item_id,
                            "score": score,
                            "overlap": overlap,
                            "question_overlap": question,
                            "answer_overlap": answer,
                        }
                    )
            verified.append(leaks)
        return verified


def _segmented(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        cut = []
        for text in texts:
            words = words_of(text.as_py() or "")
            cut.append([words[i : i + SEGMENT] for i in range(0, len(words), SEGMENT)])
        yield pa.array(cut, pa.list_(pa.list_(pa.string())))


def build_shards(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame | None:
    """The index of ``items`` (``item_id``, ``question``, ``answer``), a row per shard; none if no item has a word."""
    rows = items.select(
        F.col("item_id").cast("long").alias("item_id"),
        T.whole("question").alias("question"),
        T.whole("answer").alias("answer"),
    ).distinct()
    rows = rows.withColumn("_key", F.xxhash64("item_id", "question", "answer"))
    cut = F.arrow_udf(_segmented, "array<array<string>>")(F.concat_ws("\n", "question", "answer"))
    segments = session.stage(
        rows.withColumn("_parts", cut).select("*", F.posexplode("_parts").alias("_part", "_terms")).drop("_parts"),
        "benchmark-segments",
    )
    stats = segments.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("_terms")).alias("length")).first()
    if not stats.n:
        return None
    counted = (
        segments.select("_key", "_part", F.size("_terms").alias("_length"), F.explode("_terms").alias("_term"))
        .groupBy("_key", "_part", "_length", "_term")
        .agg(F.count(F.lit(1)).alias("_tf"))
    )
    held = counted.groupBy("_term").agg(F.count(F.lit(1)).alias("_df"))
    idf = F.log(1 + (stats.n - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    damped = F.col("_tf") * (K1 + 1) / (F.col("_tf") + K1 * (1 - B + B * F.col("_length") / stats.length))
    weighed = counted.join(held, "_term").select("_key", "_part", "_term", (idf * damped).alias("_weight"))
    own = weighed.groupBy("_key", "_part").agg(F.sum("_weight").alias("_own"))
    postings = weighed.join(own, ["_key", "_part"]).select(
        "_key", "_part", "_term", (F.col("_weight") / F.col("_own")).alias("_impact")
    )
    whole = segments.where("_part = 0").select("_key", "item_id", "question", "answer")
    if stats.n > SHARD_SEGMENTS:
        places = _places(segments)
        postings, whole = postings.join(places, "_key"), whole.join(places, "_key")
    else:
        postings, whole = (frame.withColumn("_shard", F.lit(0).cast("long")) for frame in (postings, whole))

    def built(listed: pa.Table, texts: pa.Table) -> pa.Table:
        named = {
            key: Item(item_id, question, answer)
            for key, item_id, question, answer in _tuples(texts, "_item", "item_id", "question", "answer")
        }
        index = _shard_index(sorted(_tuples(listed, "_key", "_part", "_term", "_impact")), named, threshold)
        packed = zlib.compress(pickle.dumps(index, pickle.HIGHEST_PROTOCOL), 1)
        return pa.table({"_shard": texts["_group"][:1], "_index": pa.array([packed], pa.binary())})

    # both sides come from the segments, so one needs names of its own
    whole = whole.withColumnsRenamed({"_key": "_item", "_shard": "_group"})
    shards = postings.groupBy("_shard").cogroup(whole.groupBy("_group"))
    return session.stage(shards.applyInArrow(built, "_shard long, _index binary"), "benchmark-index")


def _places(segments: DataFrame) -> DataFrame:
    """The shard of each item: that of its first segment, ``SHARD_SEGMENTS`` of them a shard."""
    sizes = segments.groupBy("_key").agg(F.count(F.lit(1)).alias("_size"))
    ends = running_total(sizes, [], ["_key"], "_size", "_end")
    return ends.select("_key", F.floor((F.col("_end") - F.col("_size")) / SHARD_SEGMENTS).alias("_shard"))


def _tuples(table: pa.Table, *names: str) -> Iterator[tuple]:
    return zip(*(table[name].to_pylist() for name in names))


def _packed(shards: DataFrame | None, numbers: tuple[int, ...]) -> Iterator[bytes]:
    """Packed shards, each fetched alone."""
    for number in numbers:
        yield bytes(shards.where(F.col("_shard") == number).first()._index)


def _numbers(shards: DataFrame | None) -> list[int]:
    return [] if shards is None else sorted(row._shard for row in shards.select("_shard").collect())


def _unpacked(packed: bytes) -> Index:
    return pickle.loads(zlib.decompress(packed))


def index_shards(items: DataFrame, threshold: float = THRESHOLD) -> Iterator[Index]:
    """The index of ``items`` (``item_id``, ``question``, ``answer``), one shard after another."""
    shards = build_shards(items, threshold)
    return map(_unpacked, _packed(shards, _numbers(shards)))


def _shard_index(listed: list[tuple], whole: dict[int, Item], threshold: float) -> Index:
    """Number the segments so that those sharing their commonest terms lie in one block."""
    terms_of: dict[tuple[int, int], dict[str, float]] = {}
    holders: dict[str, int] = {}
    for key, part, term, impact in listed:
        terms_of.setdefault((key, part), {})[term] = impact
        holders[term] = holders.get(term, 0) + 1
    profile = {s: sorted(terms, key=lambda t: (-holders[t], t))[:3] for s, terms in terms_of.items()}
    order = sorted(terms_of, key=lambda s: (profile[s], s))
    items = sorted(whole, key=lambda key: (whole[key].item_id is None, whole[key].item_id or 0, key))
    place = {key: i for i, key in enumerate(items)}
    postings = [(n, term, impact) for n, s in enumerate(order) for term, impact in terms_of[s].items()]
    return Index(postings, [whole[key] for key in items], [place[key] for key, _ in order], threshold)


def _chunks(batches: Iterator[pa.Array], chars: int) -> Iterator[list[list[str]]]:
    """Batches of texts, so many together that they have ``chars`` characters."""
    chunk, size = [], 0
    for batch in batches:
        chunk.append([text.as_py() or "" for text in batch])
        size += sum(map(len, chunk[-1]))
        if size >= chars:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _search(shards: list[Broadcast]) -> Callable[[Column], Column]:
    """Arrow function from texts to their verified leaks."""
    name, chars = uuid.uuid4().hex, CHUNK_CHARS if len(shards) > 1 else 0

    def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for chunk in _chunks(batches, chars):
            documents = [words_of(text) for batch in chunk for text in batch]
            found: list[list[dict]] = [[] for _ in documents]
            for number, shard in enumerate(shards):
                if (key := f"{name} {number}") not in _workers:  # one shard a worker
                    _workers.clear()
                    _workers[key] = _unpacked(shard.value)
                for listed, more in zip(found, _workers[key].leaks_in(documents)):
                    listed += more
            at = 0
            for batch in chunk:
                yield pa.array(found[at : at + len(batch)], ARROW_LEAK)
                at += len(batch)

    return F.arrow_udf(leaks, LEAK)


def _scanned(docs: DataFrame, items: DataFrame, scan: Callable[..., DataFrame], label: str) -> Iterator[DataFrame]:
    """``scan(search)`` for each scan of the documents that the shards of ``items`` take.

    Of several scans each is written, and its broadcasts go, before the next begins.
    """
    shards = build_shards(items)
    scans = [*batched(_numbers(shards), SHARDS_A_SCAN)]
    for numbers in scans:
        sent = [docs.sparkSession.sparkContext.broadcast(packed) for packed in _packed(shards, numbers)]
        scanned = scan(_search(sent))
        if len(scans) > 1:
            scanned = session.stage(scanned, label)
            for shard in sent:
                shard.destroy()
        yield scanned


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """A row per document and verified item: the id, ``item_id``, ``score`` and the overlaps."""

    def scan(search: Callable[[Column], Column]) -> DataFrame:
        listed = docs.select(F.col(id_column), F.explode(search(T.whole(text))).alias("_leak"))
        return listed.select(id_column, "_leak.*")

    found = None
    for part in _scanned(docs, items, scan, "leaks"):
        found = part if found is None else found.union(part)
    return found if found is not None else scan(lambda _: F.array().cast(LEAK))


@shielded
def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a verified item."""
    kept, columns = docs, docs.columns

    def scan(search: Callable[[Column], Column]) -> DataFrame:
        searched = without(kept, "_leaks").withColumn("_leaks", search(T.whole(text)))
        return searched.where(F.size("_leaks") == 0).select(*columns)

    for part in _scanned(docs, items, scan, "decontaminated"):
        kept = part
    return kept


def question_and_answer(items: DataFrame, text: str = "text") -> DataFrame:
    """Items whose text is question and answer in one: the last sentence is the answer."""
    both = r"(?s)^(.*[.!?\n])\s+(\S.*)$"
    whole = T.whole(text)
    split = whole.rlike(both)
    return items.select(
        "item_id",
        F.when(split, F.btrim(F.regexp_extract(whole, both, 1), F.lit(T.SPACES))).otherwise(whole).alias("question"),
        F.when(split, F.regexp_extract(whole, both, 2)).otherwise(F.lit("")).alias("answer"),
    )
