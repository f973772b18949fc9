"""Surrogate keys that stay: a registry of the members each dimension has had.

A load brings members; those the registry lacks get the numbers after the last
one handed out, in order of their natural keys, and keep them for good. The
numbers, the last of them and the load's name are one commit of the log, so a
load that is repeated hands out nothing, and of two loads at once the second
numbers its members anew after the first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.ordering import dense_number
from granary.plans import commits

PARTS = 32  # registry files of a dimension before they are written as one


def _paths(state: commits.Commit, dimension: str) -> dict[str, str]:
    return {name: path for name, path in state.tables.items() if name.startswith(f"{dimension}/")}


def _known(spark: SparkSession, state: commits.Commit, dimension: str) -> DataFrame | None:
    paths = list(_paths(state, dimension).values())
    return spark.read.parquet(*paths) if paths else None


def assign(
    spark: SparkSession, root: str, dimension: str, members: DataFrame, natural: str, surrogate: str, load: str
) -> DataFrame:
    """The dimension's registry ``natural, surrogate`` with every member of the load in it; null members get no key."""

    def build(parent: commits.Commit):
        loads = parent.notes.get("loads", {}).get(dimension, [])
        if load in loads:
            return None
        last = parent.notes.get("last", {}).get(dimension, 0)
        known = _known(spark, parent, dimension)
        fresh = members.select(natural).where(F.col(natural).isNotNull()).distinct()
        if known is not None:
            fresh = fresh.join(known.select(natural), natural, "left_anti")
        numbered = dense_number(fresh, [natural], surrogate).withColumn(surrogate, F.col(surrogate) + F.lit(last))
        path = f"{root}/{dimension}/{load}-{uuid.uuid4().hex}"
        numbered.write.parquet(path)
        added = spark.read.parquet(path).count()
        tables, removed = ({f"{dimension}/{load}": path} if added else {}), ()
        if added and len(_paths(parent, dimension)) + 1 > PARTS:
            together = f"{root}/{dimension}/together-{uuid.uuid4().hex}"
            known.unionByName(spark.read.parquet(path)).repartitionByRange(natural).write.parquet(together)
            tables, removed = {f"{dimension}/{load}": together}, tuple(_paths(parent, dimension))
        notes = {
            "last": parent.notes.get("last", {}) | {dimension: last + added},
            "loads": parent.notes.get("loads", {}) | {dimension: [*loads, load]},
        }
        return tables, notes, removed

    state = commits.publish(spark, root, f"{dimension}/{load}", build)
    found = _known(spark, state, dimension)
    kind = members.schema[natural].dataType.simpleString()
    return spark.createDataFrame([], f"{natural} {kind}, {surrogate} long") if found is None else found


def keyed(
    spark: SparkSession, root: str, dimension: str, dim: DataFrame, natural: str, surrogate: str, load: str
) -> DataFrame:
    """A dimension's rows with the keys that stay; replaces numbering by :func:`granary.plans.gold.keyed`."""
    return dim.join(assign(spark, root, dimension, dim, natural, surrogate, load), natural, "left")
