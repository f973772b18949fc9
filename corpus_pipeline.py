"""The corpus pipeline: documents in, shards out, one operator a stage.

Every stage reads the rows its predecessor wrote and returns the columns of
``documents``; the last adds the shard and the row's place in it. The classifier
drops what it rejects, near-duplicates leave one document of each group,
documents that hold a benchmark item go, the mix repeats or leaves out documents
so that each source meets its target, and equal texts end in one shard.

A query rather than SQL is the reference for these rows: a trained model, bit
fingerprints and seeded draws are no SQL. The tests hold each stage against a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from granary import session
from granary.llm import decontaminate, mixing, pu_classifier, sharding, simhash
from granary.llm.frames import carrying, without
from granary.llm.registry import ARROW_ROWS

SHARDS = 8
CORE = ("doc_id", "text", "source")


def _ready(spark: SparkSession) -> SparkSession:
    session.tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    network = pu_classifier.fit(docs, _table(_ready(spark), sf_dir, "labels"))
    return carrying(
        docs, CORE, lambda rows: pu_classifier.score(rows, network).where("predicted = 1").select(*rows.columns)
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    _ready(spark)
    return carrying(docs, CORE, simhash.deduplicate)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = decontaminate.question_and_answer(_table(_ready(spark), sf_dir, "benchmark"))
    return carrying(docs, CORE, lambda rows: decontaminate.decontaminate(rows, items))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the mix's order."""
    _ready(spark)
    mix = mixing.plan(docs, SHARDS)
    return carrying(docs, CORE, lambda rows: mixing.mixed(rows, mix).select(*rows.columns))


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``shard`` and ``slot``, which replace columns of these names."""
    _ready(spark)
    docs = without(docs, "shard", "slot")
    return carrying(docs, CORE, lambda rows: sharding.shard(rows, SHARDS).select(*rows.columns, "shard", "slot"))


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("source mixing", mix_sources),
    ("sharding", into_shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``; each writes its rows for the next one to read.

    What a stage read and staged itself goes once its rows are written; nothing is recomputed from it.
    """
    docs, read = _table(_ready(spark), sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with session.scratch_scope() as made:
            docs = session.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        *inner, written = made
        session.drop_paths(spark, [*read, *inner])
        read = [written]
    return STAGES[-1][1](spark, docs, sf_dir)
