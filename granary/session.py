"""Session defaults and the shared folder for data that outlives one stage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let a skewed join split its hot partitions even when a later operator
    # then needs one more shuffle: one straggler costs far more than that.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}
_scope: ContextVar[list[str] | None] = ContextVar("granary_scratch_scope", default=None)


def build(app: str = "granary", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above and any further settings."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans rely on to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    ``spark.checkpoint.dir`` names it. A local session may leave it unset and
    gets a temporary folder; on a cluster that would be one machine's disk, so
    there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(prefix="granary-", ignore_cleanup_errors=True)
    return _local_folders[app].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """The scratch paths made inside, in order; an outer scope gets them too.

    Whoever opens one knows when nothing reads them any more, and drops them.
    """
    made: list[str] = []
    outer = _scope.get()
    token = _scope.set(made)
    try:
        yield made
    finally:
        _scope.reset(token)
        if outer is not None:
            outer += made


def drop_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch paths that nothing reads any more; one that is gone is passed over."""
    for path in paths:
        location, files = file_system(spark, path)
        files.delete(location, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage so that values that depend on task layout (partition ids,
    positions) stay the same when an executor is lost, and gives the next
    passes a columnar, prunable input.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The path and the file system it belongs to, as Hadoop objects."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, files = file_system(spark, path)
    return files.exists(location)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged, once no frame reads it any more."""
    location, files = file_system(spark, f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    files.delete(location, True)
