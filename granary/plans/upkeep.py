"""Star tables and charts kept up by what changed.

A change is a row with ``sign``: +1 for a row that came, -1 for one that went; a
row that changed is both. Changes pass through joins and aggregates as signed
rows, and a table's state holds, for each group and value of its greatest
column, how many rows there are and what they sum up to. So groups vanish with
their last row, and a greatest value that goes uncovers the next one.

The state lies in buckets by a hash of the keys. A load adds a part, its folded
changes, to the buckets that they fall into and to no other; parts are signed
too, so they add up to the state and what is held is not written again. Whole
rows, few of which are equal, are written as they come and equal ones add up
with the rest. A bucket with more than ``PARTS`` parts is folded into one. What
else a load needs of its base rows it reads from their parts, so the changes
given are worked out once. Held rows of a group are looked up where some of it
went, to be sure that they ever came. The new paths,
for all tables of the load, are one commit of the log, so readers see a load
whole or not at all and a load that is repeated changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from granary.operators.key_filter import may_meet
from granary.plans import commits

BUCKETS = 64
PARTS = 8  # of a bucket, before they are folded into one
SIGN = "sign"


@dataclass(frozen=True)
class Kept:
    """A table kept up: its group columns, summed columns, and a column of which the greatest value is wanted.

    ``by`` are the columns whose hash tells the bucket, if not all keys: base
    rows that a join looks up lie by their join key. More buckets mean less to
    read for a small load; their number stays what it was at first. ``whole``
    says that hardly any rows have the same keys, so that folding a load's
    changes before they are written would shuffle them for nothing.
    """

    name: str
    keys: tuple[str, ...]
    sums: tuple[str, ...] = ()
    greatest: str | None = None
    by: tuple[str, ...] | None = None
    buckets: int = BUCKETS
    whole: bool = False

    @property
    def grain(self) -> tuple[str, ...]:
        return (*self.keys, *((self.greatest,) if self.greatest else ()))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(self.by or self.keys)), F.lit(self.buckets)).cast("int")


@dataclass(frozen=True)
class Part:
    """Changes of a load as they were written: the path, ``grain, _rows, sums, _bucket``, and a row for each bucket."""

    kept: Kept
    path: str
    delta: DataFrame
    ends: list[Row]  # bucket, least number of rows of a group, rows

    def changes(self) -> DataFrame:
        """The signed base rows, read from the part."""
        signed = self.delta.drop("_bucket").withColumnRenamed("_rows", SIGN)
        # a plan without rows, so that joins with it are left out before anything runs
        return signed if self.ends else signed.limit(0)


@dataclass(frozen=True)
class Added:
    """Signed rows added up: ``sign`` is their number, and the sums have their signs already."""

    rows: DataFrame


def changes(came: DataFrame, went: DataFrame | None = None) -> DataFrame:
    """Signed rows."""
    signed = came.withColumn(SIGN, F.lit(1).cast("long"))
    return signed if went is None else signed.unionByName(went.withColumn(SIGN, F.lit(-1).cast("long")))


def _wide(df: DataFrame, name: str) -> str:
    """A type for sums that adding up again leaves as it is."""
    kind = dict(df.dtypes)[name]
    return f"decimal(38,{kind.rstrip(')').split(',')[1]})" if kind.startswith("decimal") else "bigint"


def _folded(kept: Kept, signed: DataFrame | Added) -> DataFrame:
    """Rows and sums per group and value; the sums of equal changes cancel, those of whole rows once they are read."""
    if isinstance(signed, Added):
        return _totals(kept, signed.rows.withColumnRenamed(SIGN, "_rows"))
    if kept.whole:
        sums = [(F.col(c) * F.col(SIGN)).cast(_wide(signed, c)).alias(c) for c in kept.sums]
        return signed.select(*kept.grain, F.col(SIGN).alias("_rows"), *sums)
    sums = [F.sum(F.col(c) * F.col(SIGN)).cast(_wide(signed, c)).alias(c) for c in kept.sums]
    return signed.groupBy(*kept.grain).agg(F.sum(SIGN).alias("_rows"), *sums)


def _buckets(kept: Kept, df: DataFrame) -> list[int]:
    """Buckets that the rows fall into; at most ``buckets`` numbers."""
    return sorted(row.b for row in df.select(kept.bucket().alias("b")).distinct().collect())


def _totals(kept: Kept, parts: DataFrame) -> DataFrame:
    """``grain, _rows, sums`` with all parts added up."""
    sums = [F.sum(c).cast(_wide(parts, c)).alias(c) for c in kept.sums]
    return parts.groupBy(*kept.grain).agg(F.sum("_rows").alias("_rows"), *sums)


def _net(kept: Kept, parts: DataFrame) -> DataFrame:
    """The groups that are left once all parts are added up."""
    return _totals(kept, parts).where("_rows <> 0")


def _parts(state: commits.Commit, name: str) -> list[str]:
    """Paths of a bucket's parts, the newest last; ``tables`` has the newest alone."""
    return state.notes.get("parts", {}).get(name) or [state.tables[name]]


def _names(state: commits.Commit, kept: Kept, wanted: list[int] | None = None) -> list[str]:
    names = [f"{kept.name}/{b}" for b in (range(kept.buckets) if wanted is None else wanted)]
    return [name for name in names if name in state.tables]


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parts put together; loads may have types of their own, so each one's parts are read by themselves."""
    by_load: dict[str, list[str]] = {}
    for path in paths:
        by_load.setdefault(path.rpartition("/")[0], []).append(path)
    return reduce(DataFrame.unionByName, [spark.read.parquet(*some) for some in by_load.values()])


def _state(spark: SparkSession, state: commits.Commit, kept: Kept, wanted: list[int] | None = None) -> DataFrame | None:
    """``grain, _rows, sums`` of the parts of the wanted buckets, or of all; a group may be in several of them."""
    paths = [path for name in _names(state, kept, wanted) for path in _parts(state, name)]
    return _read(spark, paths) if paths else None


def rows(spark: SparkSession, state: commits.Commit, kept: Kept, touched_by: DataFrame, schema) -> DataFrame:
    """Base rows, signed by their number, in the buckets that ``touched_by`` falls into."""
    held = _state(spark, state, kept, _buckets(kept, touched_by)) if _names(state, kept) else None
    if held is None:
        nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
        # a plan without rows, so that joins with it are left out before anything runs
        return spark.range(0).select(*nothing, F.lit(0).cast("long").alias(SIGN)).limit(0)
    return held.withColumnRenamed("_rows", SIGN)


def joined(
    left: DataFrame, left_changes: DataFrame, right: DataFrame, right_changes: DataFrame, on: str,
    sums: dict[str, Column] | None = None,
) -> DataFrame | Added:
    """Changes of an inner join from the changes of its sides; ``left`` and ``right`` are the signed rows before.

    Rows before that meet no change are dropped where they are read. ``sums``,
    worked out from the left's columns, are for tables whose groups are columns
    of the right: the left's rows are added up by ``on`` before they are joined,
    so many of them for one key are one row to shuffle, sort and join.
    """
    names = list(sums or ())

    def ready(rows: DataFrame) -> DataFrame:
        if sums is None:
            return rows
        rows = rows.select(on, SIGN, *[value.alias(name) for name, value in sums.items()])
        signed = [F.sum(F.col(c) * F.col(SIGN)).cast(_wide(rows, c)).alias(c) for c in names]
        return rows.groupBy(on).agg(F.sum(SIGN).alias(SIGN), *signed)

    def product(a: DataFrame, b: DataFrame) -> DataFrame:
        met = a.withColumnRenamed(SIGN, "_a").join(b.withColumnRenamed(SIGN, "_b"), on)
        signed = {c: (F.col(c) * F.col("_b")).cast(_wide(a, c)) for c in names}
        return met.withColumns({SIGN: F.col("_a") * F.col("_b")} | signed).drop("_a", "_b")

    after = may_meet(right, left_changes, [on]).unionByName(right_changes)
    met = product(ready(left_changes), after)
    met = met.unionByName(product(ready(may_meet(left, right_changes, [on])), right_changes))
    return met if sums is None else Added(met)


def _all_came(held: DataFrame | None, kept: Kept, delta: DataFrame) -> bool:
    """Whether the groups that ``delta`` takes rows from hold that many."""
    columns = [*kept.grain, "_rows"]
    went = delta.where("_rows < 0")
    # the columns of the bucket have fewer values than all, so fewer bits are set and fewer rows pass by chance
    by = list(kept.by or kept.grain)
    # rows that are not folded may come in the same load
    counts = (may_meet(delta, went, by) if kept.whole else went).select(*columns)
    if held is not None:
        counts = counts.unionByName(may_meet(held, went, by).select(*columns))
    return counts.groupBy(*kept.grain).agg(F.sum("_rows").alias("_rows")).where("_rows < 0").isEmpty()


def _row_counts(spark: SparkSession, state: commits.Commit, kept: Kept, touched: list[int]) -> dict[str, int]:
    """Rows held in each touched bucket, as remembered with the commit."""
    known = state.notes.get("rows", {})
    counts = {}
    for name in _names(state, kept, touched):
        counts[name] = known[name] if name in known else _read(spark, _parts(state, name)).agg(F.sum("_rows")).first()[0]
    return counts


def _written(spark: SparkSession, kept: Kept, df: DataFrame, path: str) -> DataFrame:
    # buckets are dealt out by their groups, so a large one is written by many tasks
    dealt = df.withColumn("_bucket", kept.bucket())
    dealt.write.partitionBy("_bucket").parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def part(spark: SparkSession, root: str, load: str, kept: Kept, signed: DataFrame | Added) -> Part:
    """Write the changes of a load; they count once ``apply`` commits them."""
    path = f"{root}/{kept.name}/{load}-{uuid.uuid4().hex}"
    delta = _written(spark, kept, _folded(kept, signed), path)
    ends = delta.groupBy("_bucket").agg(F.min("_rows").alias("least"), F.sum("_rows").alias("rows")).collect()
    return Part(kept, path, delta, ends)


def _at_once(spark: SparkSession, calls: list[Callable]) -> list:
    """Results of calls that do not need each other, so that one's last tasks leave no cores idle."""
    with ThreadPoolExecutor(len(calls) or 1) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]]


def parts(spark: SparkSession, root: str, load: str, given: list[tuple[Kept, DataFrame]]) -> list[Part]:
    """Write the changes of several tables."""
    return _at_once(spark, [partial(part, spark, root, load, kept, signed) for kept, signed in given])


def _updated(spark: SparkSession, state: commits.Commit, new: Part):
    """Parts and row counts of the buckets that the changes touch, and the names of those left empty."""
    kept, path, ends = new.kept, new.path, new.ends
    shrunk = [row["_bucket"] for row in ends if row.least < 0]
    if shrunk and not _all_came(_state(spark, state, kept, shrunk), kept, new.delta.where(F.col("_bucket").isin(shrunk))):
        raise ValueError(f"{kept.name}: rows went that never came")
    counts = _row_counts(spark, state, kept, [row["_bucket"] for row in ends])
    parts, left, empty = {}, {}, []
    for row in ends:
        name = f"{kept.name}/{row['_bucket']}"
        left[name] = counts.get(name, 0) + row.rows
        parts[name] = [*(_parts(state, name) if name in state.tables else []), f"{path}/_bucket={row['_bucket']}"]
        if not left[name]:
            empty.append(name)
    long = [name for name in parts if len(parts[name]) > PARTS and name not in empty]
    if long:
        whole = _read(spark, [part for name in long for part in parts[name]])
        _written(spark, kept, _net(kept, whole), f"{path}-whole")
        parts |= {name: [f"{path}-whole/_bucket={name.rpartition('/')[2]}"] for name in long}
    return parts, left, empty


def apply(spark: SparkSession, root: str, load: str, build) -> commits.Commit:
    """Bring a load in: ``build(state)`` gives pairs of a kept table and its changes, or their parts, all committed together."""

    def made(parent: commits.Commit):
        loads = parent.notes.get("loads", [])
        if load in loads:
            return None
        parts, counts, removed = dict(parent.notes.get("parts", {})), dict(parent.notes.get("rows", {})), []
        changed = {}

        def updated(given):
            return _updated(spark, parent, given if isinstance(given, Part) else part(spark, root, load, *given))

        for new, left, empty in _at_once(spark, [partial(updated, given) for given in build(parent)]):
            parts, counts, removed = parts | new, counts | left, removed + empty
            changed |= {name: paths[-1] for name, paths in new.items() if name not in empty}
        for name in removed:
            del parts[name], counts[name]
        return changed, {"loads": [*loads, load], "parts": parts, "rows": counts}, tuple(removed)

    return commits.publish(spark, root, load, made)


def result(spark: SparkSession, root: str, kept: Kept, version: int | None = None) -> DataFrame | None:
    """The table as of now or a version: keys, ``rows``, sums and the greatest value; None if nothing ever came."""
    state = commits.current(spark, root) if version is None else commits.at(spark, root, version)
    held = _state(spark, state, kept)
    if held is None:
        return None
    if kept.whole or any(len(_parts(state, name)) > 1 for name in _names(state, kept)):
        held = _net(kept, held)
    if not kept.greatest:
        return held.withColumnRenamed("_rows", "rows")
    sums = [F.sum(c).cast(_wide(held, c)).alias(c) for c in kept.sums]
    # a group's values lie in one bucket; a group without a value keeps its row with NULL
    return held.groupBy(*kept.keys).agg(F.sum("_rows").alias("rows"), *sums, F.max(kept.greatest).alias(kept.greatest))
