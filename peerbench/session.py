"""Shared storage for intermediate tables.

Intermediate results that several jobs read are written as Parquet to the folder the cluster names in
``spark.checkpoint.dir``.  A written table survives the loss of executors, and its size on disk is what
Catalyst compares with the broadcast threshold, so small ones are broadcast and large ones are not.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Layers are read more often than written, and their size on disk counts.
CODEC = "zstd"
# A table of which this much has been shuffled is met by broadcast: what it takes in memory is a small multiple.
BROADCAST_BYTES = 64 << 20
# Wide rows that a task sorts in memory: about 600 bytes each.
TASK_ROWS = 1 << 19

_PARTITIONS = "spark.sql.shuffle.partitions"
_sizes: list[int] = []
_configured: list[str] = []
_sizing = threading.Lock()

_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
_RUNTIME_BROADCAST = "spark.sql.adaptive.autoBroadcastJoinThreshold"
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Blocks that hold a setting of a session at the moment, and its value before the first of them.
_held: dict[tuple[int, str], tuple[int, str | None]] = {}
_holding = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``; a temporary one only for a local session without it.

    The session's own checkpoint setting is left as it is.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="peerbench-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other table uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/peerbench/{app}/{name}-{uuid.uuid4().hex}"


def task_count(spark: SparkSession, rows: int) -> int:
    """Tasks for a shuffle of ``rows`` rows: as many as the session sets, more if a task got over ``TASK_ROWS`` rows."""
    with _sizing:
        configured = int(_configured[0] if _sizes else spark.conf.get(_PARTITIONS))
    return max(configured, -(-rows // TASK_ROWS))


@contextmanager
def sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside have ``task_count`` tasks after a shuffle, so their sorts need no disk; adaptive execution may
    still merge small ones.  The session's own setting is back when the last of several such blocks ends."""
    count = task_count(spark, rows)
    with _sizing:
        if not _sizes:
            _configured[:] = [spark.conf.get(_PARTITIONS)]
        _sizes.append(count)
        spark.conf.set(_PARTITIONS, str(max(_sizes)))
    try:
        yield
    finally:
        with _sizing:
            _sizes.remove(count)
            spark.conf.set(_PARTITIONS, str(max(_sizes)) if _sizes else _configured[0])


@contextmanager
def held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Jobs run inside see this setting; the session's own value is back when the last of several such blocks ends."""
    place = (id(spark), key)
    with _holding:
        count, before = _held.get(place, (0, spark.conf.get(key, None)))
        _held[place] = (count + 1, before)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _holding:
            count, before = _held.pop(place)
            if count > 1:
                _held[place] = (count - 1, before)
            elif before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


def tidied(spark: SparkSession) -> AbstractContextManager[None]:
    """What jobs run inside have shuffled is deleted as soon as each is done, not when the driver next collects garbage.

    For jobs that write a table: what follows reads the table, so disks hold the shuffles of one job at a time.
    """
    return held(spark, _TIDY, "true")


def meeting_small(spark: SparkSession) -> AbstractContextManager[None]:
    """Joins of jobs run inside broadcast a side once it has turned out, in its shuffle, to have ``BROADCAST_BYTES`` at
    most, so that many wide rows are not shuffled for it.  A session that broadcasts more, or nothing, does as it is set."""
    own = spark.conf.get(_RUNTIME_BROADCAST, None) or spark.conf.get(_BROADCAST)
    if not own.startswith("-"):
        size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own)
        own = str(max(size, BROADCAST_BYTES))
    return held(spark, _RUNTIME_BROADCAST, own)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with tidied(spark):
        df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever file system it is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Delete everything this application has stored; results that still read it fail afterwards."""
    drop(spark, f"{shared_folder(spark)}/peerbench/{spark.sparkContext.applicationId}")
