"""SimHash near-duplicates: fingerprints linked through BK-trees.

A text's 64-bit fingerprint takes the majority of each bit over the XXH64
hashes of its word shingles. Equal fingerprints are one node, so copies cost
nothing further. Nodes are sharded by the bands in which two fingerprints at
most ``radius`` bits apart must agree: of ``bands`` bands any ``bands - radius``
chosen ones, so no link is lost. A shard holds one BK-tree, whose children are
keyed by their Hamming distance to the parent; every member walks it and
follows only the edges within the radius. The trees are not broadcast, since
together they are as large as the corpus: a tree stands in the task that holds
all the members that can match it. A shard of more than ``SHARD`` nodes is cut
into pieces, and each pair of pieces is a task's work of its own.

More nodes mean more bands, so that a shard stays small at any size; the
answer is the same for any number of bands above the radius.

A tree's links leave as one star per local component; components of the whole
are joined up in Spark.

Defined results: null and empty texts, and texts without words, have
fingerprint 0 and are linked like any other; texts of any length are hashed
whole; a bit set in exactly half the hashes is 0; repeated rows are copies; null ids
are passed over when a component takes its smallest id, which is null only if
it has no other; an empty table gives an empty result. Input columns named
like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary import session
from granary.llm import text as T
from granary.llm.components import components
from granary.llm.frames import shielded

SHINGLE = 4
RADIUS = 4
SEED = 42
SHARD = 4096
MEAN_SHARD = 256
LEAF = 8

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = np.arange(8, dtype=np.intp) * 256


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a text in UTF-8."""
    words = raw.lower().split()  # for bytes both know ASCII only
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    digest = xxhash.xxh64_intdigest
    starts = [0, *ends]
    hashes = np.array([digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[shingle - 1 :])], dtype="<u8")
    tally = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _PLACES).ravel(), minlength=2048).reshape(8, 256)
    majority = (tally @ _BITS).ravel() * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        prints = np.array([fingerprint(text) for text in texts.cast(pa.binary()).to_pylist()], dtype=np.uint64)
        yield pa.array(prints.view(np.int64), pa.int64())


def with_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_print``, the fingerprint as a signed long."""
    return docs.withColumn("_print", F.arrow_udf(_fingerprints, "long")(T.whole(text)))


class Tree:
    """A BK-tree over distinct fingerprints; up to ``LEAF`` of them stay together in a leaf."""

    def __init__(self, prints: np.ndarray, places: np.ndarray):
        self.prints, self.places, self.children = prints, places, {}
        if len(prints) > LEAF:
            self.prints, rest = prints[:1], prints[1:]
            self.places, rest_places = places[:1], places[1:]
            apart = np.bitwise_count(rest ^ self.prints[0])
            for distance in np.unique(apart):
                here = apart == distance
                self.children[int(distance)] = Tree(rest[here], rest_places[here])

    def links(self, prints: np.ndarray, places: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the queries and of the nodes within the radius of each other."""
        stack = [(self, prints, places)]
        while stack:
            node, asked, at = stack.pop()
            apart = np.bitwise_count(asked[:, None] ^ node.prints[None, :])
            query, found = np.nonzero(apart <= radius)
            yield at[query], node.places[found]
            if node.children:
                away = apart[:, 0].astype(np.int16)
                for distance, child in node.children.items():
                    follow = np.abs(away - distance) <= radius
                    if follow.any():
                        stack.append((child, asked[follow], at[follow]))


def _local_roots(size: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[int]:
    """Smallest place that each place reaches."""
    root = list(range(size))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for left, right in links:
        apart = left != right
        for x, y in zip(left[apart].tolist(), right[apart].tolist()):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(size)]


def _linked(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Stars ``a, b`` of the shards, whose rows follow each other: shard, pair, own piece, fingerprint."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held = None

    def stars(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        changes = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
        left, right = [], []
        for low, high in zip([0, *changes.tolist()], [*changes.tolist(), len(rows)]):
            if high - low < 2:
                continue
            own, prints = rows[low:high, 4], rows[low:high, 5].view(np.uint64)
            places, first = np.arange(high - low), own == rows[low, 2]
            asking = first if rows[low, 2] == rows[low, 3] else ~first
            tree = Tree(prints[first], places[first])
            roots = _local_roots(high - low, tree.links(prints[asking], places[asking], radius))
            for place, root in enumerate(roots):
                if place != root:
                    left.append(rows[low + place, 5])
                    right.append(rows[low + root, 5])
        if left:
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([column.to_numpy(zero_copy_only=False).astype(np.int64) for column in batch.columns], axis=1)
        rows = np.ascontiguousarray(rows if held is None else np.concatenate([held, rows]))
        same = (rows[:, :4] == rows[-1, :4]).all(axis=1)
        cut = len(rows) - int(same[::-1].argmin()) if not same.all() else 0
        yield from stars(rows[:cut]) if cut else ()
        held = rows[cut:]
    if held is not None:
        yield from stars(np.ascontiguousarray(held))


def band_masks(nodes: int, radius: int) -> list[int]:
    """Masks of the bands to agree in, enough of them for shards of about ``MEAN_SHARD`` nodes."""
    for bands in range(radius + 1, 65):
        edges = [64 * i // bands for i in range(bands + 1)]
        masks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
        chosen = [sum(some) for some in combinations(masks, bands - radius)]
        if bands == radius + 4 or nodes >> min(mask.bit_count() for mask in chosen) <= MEAN_SHARD:
            return chosen
    raise ValueError("the radius leaves no bands")


def link_prints(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` that join up all fingerprints (column ``_print``, distinct) at most ``radius`` bits apart."""
    masks = band_masks(prints.count(), radius)
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    shard = F.explode(
        F.array(*[F.struct(F.lit(i).alias("band"), F.col("_print").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)])
    )
    keyed = prints.select("_print", shard.alias("s")).select("_print", "s.band", "s.bits")
    large = keyed.groupBy("band", "bits").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > SHARD)
    pieces = F.coalesce(F.ceil(F.col("_n") / F.lit(SHARD)), F.lit(1)).cast("int")
    routed = (
        keyed.join(large, ["band", "bits"], "left")
        .withColumn("_pieces", pieces)
        .withColumn("own", F.pmod(F.xxhash64("_print"), F.col("_pieces")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .select(
            F.col("band").cast("long").alias("band"),
            "bits",
            F.least("own", "other").cast("long").alias("i"),
            F.greatest("own", "other").cast("long").alias("j"),
            F.col("own").cast("long").alias("own"),
            "_print",
        )
        .repartition("band", "bits", "i", "j")
        .sortWithinPartitions("band", "bits", "i", "j", "own", "_print")
    )
    return routed.mapInArrow(lambda batches: _linked(batches, radius), "a long, b long")


def classes(docs: DataFrame, radius: int = RADIUS, id_column: str = "doc_id") -> DataFrame:
    """``_print, _class, component_id`` for each fingerprint of ``docs`` (columns ``_print`` and the id).

    ``_class`` is the smallest fingerprint reachable, ``component_id`` the smallest id.
    """
    nodes = session.stage(docs.groupBy("_print").agg(F.min(id_column).alias("_low")), "fingerprints")
    roots = components(link_prints(nodes.select("_print"), radius)).toDF("_print", "_class")
    linked = session.stage(nodes.join(roots, "_print"), "linked-fingerprints")
    lowest = linked.groupBy("_class").agg(F.min("_low").alias("_lowest"))
    known = linked.join(lowest, "_class").select("_print", "_class", "_lowest")
    return nodes.join(known, "_print", "left").select(
        "_print", F.coalesce("_class", "_print").alias("_class"), F.coalesce("_lowest", "_low").alias("component_id")
    )


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    prints = session.stage(
        with_fingerprint(docs.select(F.col(id_column), F.col(text)), text).select(id_column, "_print"), "document-prints"
    )
    known = classes(prints, radius, id_column)
    return prints.join(known, "_print").select(
        id_column, F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"), "component_id"
    )


@shielded
def deduplicate(docs: DataFrame, text: str = "text", id_column: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the smallest id's, the first of them if that repeats."""
    columns = docs.columns
    held = session.stage(
        with_fingerprint(docs, text).withColumn("_row", F.monotonically_increasing_id()), "documents-with-prints"
    )
    narrow = held.select("_print", F.col(id_column).alias("_id"), "_row")
    known = classes(narrow, radius, "_id").select("_print", "_class")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), F.col("_row"))).alias("first")
    kept = narrow.join(known, "_print").groupBy("_class").agg(first).select(F.col("first._row").alias("_row"))
    return held.join(kept, "_row", "left_semi").select(*columns)
