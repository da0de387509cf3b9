"""Session-level helpers: local sessions, and shared storage for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("studytrace")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a
    cluster without it is an error, since a machine-local folder would lose
    the data together with its executor.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder on a cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="studytrace-"))
    return context.getCheckpointDir()


_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table written during a job."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for scope in _SCOPES.get()[-1:]:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables of a job when it ends, also by an error.

    For jobs whose result is stored, or on the driver: data frames that read
    those tables are of no use afterwards. Without a scope tables are left for
    the cluster's housekeeping, as checkpoints are.
    """
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in paths:
            place = hadoop(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def durable(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage of ``df`` with a table written to the shared folder.

    Later readers scan only the columns they need, row counts come from file
    footers, and a lost executor costs a re-read, not a recomputation. Readers
    of one ``partition_by`` value touch only that value's files.
    """
    path = scratch_path(df.sparkSession, "table")
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
