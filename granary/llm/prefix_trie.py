"""Conversation prefix trie, rolled up band by band.

A node is a sequence of first turns that some conversation starts with. A turn
is told by the SHA-256 of its role and text; a node by its depth and two exact
sums of 64-bit hashes of (place, turn), which prefix sums give to every turn of
every conversation at once, however long one conversation is.

Totals over subtrees: depths are cut into bands of fixed height. Inside a band
each node explodes to its ancestors there, never further. The nodes at the tops
of bands form a coarse trie, which is completed from the deepest band upwards;
then each band's lower ends hand the completed totals of what hangs below them
to their ancestors in the band. With a height near the square root of the
greatest depth, both the rounds and the explosion of a node stay below that.

Conversations of any length and prefixes shared by any number of them spread
over tasks: places and sums come from range slices (``ordering``), counts
combine map-side, and joins are of staged tables, whose hot keys AQE splits.
The digest of the conversations that end at a node is one sequence, so one task
hashes it, from chunks of ids that the slices have joined up before.

Defined results: turns come in order of ``turn``, nulls first, ties by the
turn's digest; null roles and texts count as empty; texts of any length are
hashed and counted whole; repeated rows are turns of their own; the rows of a
null conversation id are one conversation, which is not rebuilt, counts as a
member, is never the smallest and stands first, as an empty string, among the
ends; an empty table gives an empty result. Other input columns are not needed
and are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary import session
from granary.llm import text as T
from granary.operators.ordering import ordered_slices

LEAST_HEIGHT = 8
CHUNK = 4096  # ids joined up in one piece
HEAD = 3  # most turns that a rebuilt conversation takes from another

EXACT = "decimal(38,0)"
CONVERSATION = ("_none", "conv_id")  # a null id is a key of its own


def turn_digests(turns: DataFrame) -> DataFrame:
    """``_none, conv_id, turn, digest, words``: what the trie needs of each turn."""
    role, said = T.whole("role"), T.whole("text")
    return turns.select(
        F.col("conv_id").isNull().alias("_none"),
        F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv_id"),
        F.col("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, said).cast("binary"), 256)).alias("digest"),
        F.regexp_count(said, F.lit(T.WORD)).cast("long").alias("words"),
    )


def running_sums(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], sums: dict[str, Column], label: str) -> DataFrame:
    """Running sums per key along an order, this row included, and ``_slice``.

    The rows are cut into range slices, so a key of any size spreads over many tasks.
    """
    values = {f"_value_{name}": value for name, value in sums.items()}
    slices = ordered_slices(rows.withColumns(values), [*keys, *order], label)
    by_key = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_slice", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    added = slices.groupBy("_slice", *keys).agg(*[F.sum(f"_value_{n}").alias(f"_sum_{n}") for n in sums])
    carried = added.select(
        "_slice", *keys, *[F.coalesce(F.sum(f"_sum_{n}").over(by_key), F.lit(0)).alias(f"_carry_{n}") for n in sums]
    )
    return slices.join(session.stage(carried, f"{label}-carry"), ["_slice", *keys]).select(
        *rows.columns,
        "_slice",
        *[(F.sum(f"_value_{n}").over(inside) + F.col(f"_carry_{n}")).alias(n) for n in sums],
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations ``_none, conv_id, turns`` and their rebuilt turns ``_none, conv_id, d, digest, words``."""
    placed = session.stage(
        running_sums(turn_digests(turns), CONVERSATION, ("turn", "digest"), {"i": F.lit(1).cast("long")}, "turns").drop("_slice"),
        "placed-turns",
    )
    known = session.stage(placed.groupBy(*CONVERSATION).agg(F.max("i").alias("own")), "conversations")
    named, key = ~F.col("_none"), F.col("conv_id")
    lending = known.withColumns({
        "base": F.when(named, key - key % 20),
        "h": F.when(named, F.crc32(key.cast("string").cast("binary")) % (HEAD + 1)).otherwise(0),
    })
    sizes = known.where(named).select(key.alias("base"), F.col("own").alias("base_turns"))
    taken = F.least("h", F.coalesce("base_turns", F.lit(0)))
    shares = session.stage(
        lending.join(sizes, "base", "left").select(
            *CONVERSATION, "base", "h", taken.alias("taken"), (F.greatest(F.col("own") - F.col("h"), F.lit(0)) + taken).alias("turns")
        ),
        "conversation-heads",
    )
    first = placed.where((F.col("i") <= HEAD) & named)
    # at most 39 conversations share a base, and HEAD of its turns are taken
    lent = shares.where("taken > 0").join(
        first.select(F.col("conv_id").alias("base"), F.col("i").alias("d"), "digest", "words"), "base"
    )
    lent = lent.where("d <= taken").select(*CONVERSATION, "d", "digest", "words")
    own = placed.join(shares.select(*CONVERSATION, "h", "taken"), list(CONVERSATION)).where("i > h")
    own = own.select(*CONVERSATION, (F.col("i") - F.col("h") + F.col("taken")).alias("d"), "digest", "words")
    return shares.select(*CONVERSATION, "turns"), lent.unionByName(own)


def _node(depth: Column, a: Column, b: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", depth, a, b).cast("binary")))


def prefixes(turns: DataFrame) -> DataFrame:
    """Rebuilt turns with ``node`` and ``parent``: the prefix that ends with the turn, and that before it."""
    hashes = {n: F.xxhash64(F.lit(seed), "d", "digest").cast(EXACT) for seed, n in ((1, "a"), (2, "b"))}
    summed = running_sums(turns, CONVERSATION, ("d",), hashes, "prefixes")
    before = [F.col(n) - value for n, value in hashes.items()]
    return summed.select(
        *CONVERSATION, "d", "words", _node(F.col("d"), F.col("a"), F.col("b")).alias("node"),
        _node(F.col("d") - 1, *[b.cast(summed.schema[n].dataType) for n, b in zip("ab", before)]).alias("parent"),
    )


_ENDS = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's chunks, which follow each other in order; one chunk at a time is held."""
    chunks = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    done: list[tuple] = []
    for node, own in groupby(chunks, key=lambda row: row[0]):
        running, begun = hashlib.sha256(), False
        for _, ids in own:
            running.update(b"," * begun + ids.encode())
            begun = True
        done.append((node, running.hexdigest()))
        if len(done) == CHUNK:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done), _ENDS)], schema=_ENDS)
            done = []
    if done:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done), _ENDS)], schema=_ENDS)


def ends(last: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of ``node, _none, conv_id``: the digest of the ids that end at each node."""
    slices = ordered_slices(last.select("node", F.struct(~F.col("_none"), "conv_id").alias("_id"), *CONVERSATION), ["node", "_id"], "ends")
    place = F.row_number().over(Window.partitionBy("_slice", "node").orderBy("_at"))
    said = F.when(F.col("_none"), "").otherwise(F.col("conv_id").cast("string"))
    chunked = slices.withColumn("_chunk", F.floor((place - 1) / CHUNK)).groupBy("node", "_slice", "_chunk")
    joined = chunked.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", said.alias("id")))), lambda x: x["id"]), ",").alias("ids")
    )
    return (
        joined.repartition("node").sortWithinPartitions("node", "_slice", "_chunk").select("node", "ids")
        .mapInArrow(_hashed, "node binary, ends_sha256 string")
    )


def band_height(deepest: int) -> int:
    """Near the square root of the greatest depth, so that neither bands nor their heights grow beyond it."""
    return max(LEAST_HEIGHT, int(deepest**0.5 + 0.999))


def subtree_totals(nodes: DataFrame, paths: DataFrame, values: list[str], deepest: int, height: int) -> DataFrame:
    """``node`` and the sums of ``values`` over each node's subtree, itself included.

    ``nodes`` has ``node, parent, d, conv, values``, where ``conv`` is a key whose
    rows ``conv, d, node`` in ``paths`` hold the node's ancestors.
    """
    band = F.floor(F.col("d") / height)
    above = paths.select("conv", band.alias("band"), F.col("d").alias("upper_d"), F.col("node").alias("upper"))
    # a node meets at most ``height`` ancestors: those of one conversation's rows in one band
    pairs = session.stage(
        nodes.withColumn("band", band).join(above, ["conv", "band"]).where("upper_d <= d").select(
            "node", "d", "band", "upper", "upper_d", *values
        ),
        "band-ancestors",
    )
    sums = [F.sum(v).cast("long").alias(v) for v in values]
    if deepest < height:  # one band only
        return pairs.groupBy(F.col("upper").alias("node")).agg(*sums)
    within = session.stage(pairs.groupBy(F.col("upper").alias("node"), F.col("upper_d").alias("d"), "band").agg(*sums), "band-totals")
    # the coarse trie: each band's tops, and the top that each band's lower end hangs from
    lower = session.stage(
        pairs.where(F.col("d") % height == height - 1).select(F.col("node").alias("lower"), "upper", "upper_d", "band"), "band-ends"
    )
    hung = nodes.where(f"d % {height} = 0 and d > 0").select("node", F.col("parent").alias("lower"))
    tops = session.stage(within.where(F.col("d") % height == 0), "band-tops")
    done, form = session.scratch_path(nodes.sparkSession, "bands"), "lower binary, " + ", ".join(f"{v} long" for v in values)
    finished = None
    for number in range(deepest // height, 0, -1):
        here = tops.where(F.col("band") == number).select("node", *values)
        if finished is not None:
            below = finished.join(lower.where((F.col("band") == number) & (F.col("upper_d") == number * height)), "lower")
            here = here.unionByName(below.select(F.col("upper").alias("node"), *values)).groupBy("node").agg(*sums)
        # completed totals of this band's tops, by the node above that they hang from
        here.join(hung, "node").groupBy("lower").agg(*sums).write.parquet(f"{done}/band={number}")
        finished = nodes.sparkSession.read.schema(form).parquet(f"{done}/band={number}")
    handed = nodes.sparkSession.read.schema(form).parquet(f"{done}/*")
    from_below = handed.join(lower, "lower").select(F.col("upper").alias("node"), *values)
    return within.select("node", *values).unionByName(from_below).groupBy("node").agg(*sums)


def trie(turns: DataFrame, height: int | None = None) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``conv_id`` is the node's smallest member; with ``depth`` it names the node.
    """
    spark = turns.sparkSession
    conversations, sequences = rebuilt(turns)
    all_of_them = conversations.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(~F.col("_none"), F.col("conv_id"))).alias("least"),
        F.max("turns").alias("deepest"),
    ).first()
    schema = (
        "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string"
    )
    if not all_of_them.n:
        return spark.createDataFrame([], schema)
    deepest = int(all_of_them.deepest)
    height = height or band_height(deepest)
    paths = session.stage(prefixes(sequences), "prefix-rows")

    key = F.struct(*CONVERSATION)
    found = session.stage(
        paths.groupBy("node").agg(
            F.min(key).alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.first("parent").alias("parent"),
            F.first("d").alias("d"), F.first("words").alias("words"),
        ),
        "trie-nodes",
    )
    children = session.stage(found.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children")), "children")
    counted = found.join(children, "node", "left").withColumns(
        {"n_children": F.coalesce("n_children", F.lit(0)), "saved": (F.col("n_convs") - 1) * F.col("words")}
    )
    nodes = session.stage(
        counted.withColumn("leaf", (F.col("n_children") == 0).cast("long")).drop("words"), "counted-nodes"
    )
    # the root is every node's ancestor, so its totals are plain sums and it takes part in no join
    below = subtree_totals(
        nodes.select("node", "parent", (F.col("d") - 1).alias("d"), "conv", "leaf", "saved"),
        paths.select(key.alias("conv"), (F.col("d") - 1).alias("d"), "node"), ["leaf", "saved"], max(0, deepest - 1), height,
    ) if deepest else None

    lasts = conversations.where("turns > 0").join(
        paths.select(*CONVERSATION, F.col("d").alias("turns"), "node"), [*CONVERSATION, "turns"]
    )
    top = bytearray(hashlib.md5(b"0:0:0").digest())
    endings = ends(lasts.select("node", *CONVERSATION).unionByName(
        conversations.where("turns = 0").select(F.lit(top).alias("node"), *CONVERSATION)
    ))
    endings = session.stage(endings, "node-ends")
    none = F.lit(hashlib.sha256().hexdigest())

    own_id = F.when(~F.col("conv._none"), F.col("conv.conv_id"))
    result = None
    if below is not None:
        ids = nodes.select(F.col("node").alias("parent"), own_id.alias("parent_conv_id"))
        told = nodes.where("d > 1").join(ids, "parent").unionByName(
            nodes.where("d = 1").withColumn("parent_conv_id", F.lit(all_of_them.least).cast("long"))
        )
        totals = below.select("node", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
        result = told.join(totals, "node").join(endings, "node", "left").select(
            own_id.alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
            "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    whole = nodes.agg(
        F.count_if(F.col("d") == 1).alias("n_children"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("leaves"),
        F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"),
    )
    of_root = endings.where(F.col("node") == F.lit(top)).agg(F.max("ends_sha256")).first()[0]
    root_row = whole.select(
        F.lit(all_of_them.least).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(all_of_them.n).cast("long").alias("n_convs"), "n_children",
        F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"),
        (none if of_root is None else F.lit(of_root)).alias("ends_sha256"),
    )
    return root_row if result is None else result.unionByName(root_row)
