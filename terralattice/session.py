"""Session helpers."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only on a single machine, where driver and executors are one, may it be unset:
    then a temporary folder is made, once per driver process, and removed at its end.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or _single_machine_dir()


@functools.cache
def _single_machine_dir() -> str:
    path = tempfile.mkdtemp(prefix="terralattice-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


# Settings of every query.
GENERAL = {"spark.sql.session.timeZone": "UTC"}

# Settings of a wide gridding job. A join may reuse a partitioning on part of
# its keys; AQE may hash-join partitions whose measured size fits in memory; and
# generated methods beyond HotSpot's compile limit of 8000 bytes, which 32 band
# sums exceed, are replaced by ones it compiles. A few bytes of shuffled pixels become
# many targets, so a task reads little, and a batch of array rows for Python is small.
GRIDDING = {
    **GENERAL,
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in GENERAL.items():
        spark.conf.set(name, value)
    return spark


def gridding_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster with the gridding settings; the caller's stays as it is."""
    own = spark.newSession()
    for name, value in GRIDDING.items():
        own.conf.set(name, value)
    return own


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder of any store Spark reaches; none where it does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of any store Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage through a written table, so lost executors cost no recompute."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


FEW = 100_000  # rows that one task writes and reads


def gathered(df: DataFrame, label: str) -> DataFrame:
    """Materialize; up to FEW rows become one file that one task reads, so that what is grouped or joined by their keys alone needs no shuffle.

    Otherwise a small table costs a full set of tasks, files and shuffle blocks at
    each step, and its many footers hide how small it is from the choice of a join.
    """
    made = materialize(df, label)
    return made if made.count() > FEW else materialize(made.coalesce(1), label).coalesce(1)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, shuffle files go with the query that wrote them, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)
